"""quorum: survey enrichment, rule classification and scoring on Spark.

Subpackages: ``functions`` (Column builders), ``operators`` (DataFrame ->
DataFrame steps), ``sources`` (reads and sinks), ``plans`` (end-to-end
pipelines), ``streaming`` (the same row-local steps on a file stream),
``config`` (fixed rule values).
"""
