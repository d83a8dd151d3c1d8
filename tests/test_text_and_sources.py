"""Accent folding over the whole plane, null tokens, optional sheets, schema metadata."""

import unicodedata

import pytest
from pyspark.sql import functions as F

from quorum.functions import schema as SCH
from quorum.functions import text as TX
from quorum.operators import quality as DQ
from quorum.sources import io as IO


def folded(t):
    return "".join(c for c in unicodedata.normalize("NFKD", t) if not unicodedata.combining(c))


def test_accents_over_the_whole_plane(spark):
    chars = [chr(c) for c in range(0x20, 0x10000) if not 0xD800 <= c < 0xE000 and not 0xAC00 <= c < 0xD7A4]
    rows = [("x" + "".join(chars[k : k + 50]) + "y",) for k in range(0, len(chars), 50)]
    df = spark.createDataFrame(rows, "t string").select("t", TX.remove_accents(F.col("t")).alias("n"))
    wrong = [r.t for r in df.collect() if r.n != folded(r.t)]
    assert not wrong
    assert spark.range(1).select(TX.remove_accents(F.lit(None).cast("string")).alias("n")).first().n is None


@pytest.mark.parametrize("text,slug", [("A\u2013B", "ab"), ("  Tele Consulta! ", "tele_consulta"), ("\u6f22", "sem_nome"), (None, "sem_nome"), ("\u00c9 \ufb01m", "e_fim")])
def test_slug_drops_what_is_not_ascii(spark, text, slug):
    assert spark.createDataFrame([(text,)], "t string").select(TX.slug(F.col("t")).alias("s")).first().s == slug


PANDAS_TOKENS = ["", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL",
                 "NaN", "None", "n/a", "nan", "null"]


def test_every_null_token_is_read_as_null(spark, tmp_path):
    assert sorted(IO.NULL_TOKENS) == sorted(PANDAS_TOKENS)
    path = tmp_path / "a.csv"
    path.write_text("id,LOCAL\n" + "".join(f'{k},"{t}"\n' for k, t in enumerate([*PANDAS_TOKENS, "N\\A", "nada"])))
    rows = {int(r.id): r.LOCAL for r in IO.read_survey_csv(spark, str(path)).collect()}
    assert [rows[k] for k in range(len(PANDAS_TOKENS))] == [None] * len(PANDAS_TOKENS)
    assert rows[len(PANDAS_TOKENS) + 1] == "nada"
    assert [r.LOCAL for r in IO.read_csv_columns(spark, str(path), ["LOCAL"]).collect()].count(None) == len(PANDAS_TOKENS)


def test_a_file_with_other_column_order_stops_the_read(spark, tmp_path):
    (tmp_path / "a.csv").write_text("LOCAL,UF\nx,SP\n")
    (tmp_path / "b.csv").write_text("UF,LOCAL\nSP,x\n")
    with pytest.raises(Exception, match="(?i)header"):
        IO.read_survey_csv(spark, str(tmp_path)).collect()


def test_line_feeds_in_fields_when_asked(spark, tmp_path):
    path = tmp_path / "a.csv"
    path.write_text('LOCAL,UF\n"two\nlines",SP\n')
    assert IO.read_survey_csv(spark, str(path), multi_line=True).first().LOCAL == "two\nlines"


def test_strict_sink(spark, tmp_path):
    df = spark.createDataFrame([("3", "x"), (None, "y")], "TIPO string, LOCAL string")
    with pytest.raises(Exception, match="must be int64"):
        IO.write_survey_csv(df, str(tmp_path / "strict"))
    IO.write_survey_csv(df, str(tmp_path / "loose"), strict_ints=False)


def test_only_a_missing_path_is_optional(spark, tmp_path):
    assert IO.read_optional(spark, None) is None
    assert IO.read_optional(spark, str(tmp_path / "absent")) is None
    (tmp_path / "broken.parquet").write_text("no parquet")
    with pytest.raises(Exception):
        IO.read_optional(spark, str(tmp_path / "broken.parquet"))


def test_schema_metadata(spark):
    df = spark.createDataFrame([("1", 2.0, 3)], "TIPO string, NOTA5 double, `Local Editado` int")
    assert set(SCH.expected_types(df)) == {"TIPO", "NOTA5"}
    assert [tuple(r) for r in SCH.type_divergences(spark, df).collect()] == [("TIPO", "bigint", "string")]
    assert SCH.missing_columns(df, ["TIPO", "UF"]) == ["UF"]
    assert SCH.resolve_column(df, "LOCAL_EDITADO") == "Local Editado"
    with pytest.raises(ValueError):
        SCH.resolve_column(df, "nada")


def test_score_violations_report_every_reason(spark):
    df = spark.createDataFrame([(1, "5.5"), (2, " "), (3, None), (4, "abc"), (5, "3"), (6, "0")], "id int, NOTA1 string")
    found = {(r.id, r.MOTIVO) for r in DQ.score_violations(df, ["NOTA1"], ["id"]).collect()}
    assert found == {(1, "valor numerico nao inteiro"), (1, "valor fora do intervalo 1 a 5"), (4, "valor nao numerico"), (6, "valor fora do intervalo 1 a 5")}


def test_output_against_lookup(spark):
    out = spark.createDataFrame([("a", "x"), ("b", None), ("c", "z"), (None, None), ("a", None)], "k string, v string")
    dim = spark.createDataFrame([("a", "x"), ("b", "y"), ("d", None)], "dk string, dv string")
    r = DQ.output_vs_lookup(out, dim, F.col("k"), "v", "dk", "dv").first()
    assert (r.SEM_CORRESPONDENCIA, r.DIVERGENTES) == (2, 2)
