import re

import pytest

from quorum.llm import unit_dedup

PASSAGE = "This passage of more than eight words stands in several documents. And its second sentence has enough words of its own too."


def brute(rows, unit, least):
    """All units in rank order; every later one of a kind goes."""
    found = []
    for i, t in rows:
        at = 0
        for k, m in enumerate(re.finditer(unit_dedup.TILES[unit], t or "")):
            assert m.start() == at
            at = m.end()
            words = m.group().lower().split()
            if len(words) >= max(least, 1):
                found.append((i, k, m.start(), len(m.group().rstrip(" \t\n\x0b\x0c\r")), tuple(words)))
        assert at == len(t or "")
    first, count, out = {}, {}, []
    for f in found:
        count[f[4]] = count.get(f[4], 0) + 1
    for f in sorted(found, key=lambda f: (f[0], f[2])):
        keep = first.setdefault(f[4], f[0])
        if (f[0], f[2]) != next((g[0], g[2]) for g in sorted(found, key=lambda g: (g[0], g[2])) if g[4] == f[4]):
            out.append((f[0], f[1], f[2], f[3], keep, count[f[4]]))
    return sorted(out)


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(1, "Own words of the first document, which nobody else has written down. " + PASSAGE + " The end."),
            (2, "Start\n" + PASSAGE.upper() + "\nother text that only the second document holds in its last line"),
            (3, PASSAGE + " " + PASSAGE), (4, None), (5, ""), (6, "short. short. short."), (7, "no copies of anything are in this one at all, really."),
            (8, "one two three four five six seven eight\n\nnext paragraph\nwith two lines\n\none two three four five six seven eight")]
    return spark.createDataFrame([(i, t, "clash") for i, t in rows], "doc_id long, text string, start string")


@pytest.mark.parametrize("unit,least", [("sentence", 8), ("line", 2), ("paragraph", 2), ("sentence", 1)])
def test_against_brute_force(docs, unit, least):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert sorted(tuple(r) for r in unit_dedup.removed(docs, unit, least).collect()) == brute(rows, unit, least)


def test_cleaned_texts(docs):
    spans = unit_dedup.removed(docs)
    texts = {r.doc_id: r.text for r in unit_dedup.cleaned(docs, spans).collect()}
    assert texts[1].count("stands in several documents") == 1
    assert not any("stands in several" in (t or "").lower() for i, t in texts.items() if i != 1)
    before = {r.doc_id: r.text for r in docs.collect()}
    assert all(texts[i] == before[i] for i in (1, 4, 5, 6, 7))


def test_odd_rows(odd, empty):
    assert {r.doc_id for r in unit_dedup.removed(odd).collect()} == {2}
    assert unit_dedup.removed(empty).count() == 0


def test_short_units_inside_a_repeated_run_go_too(spark):
    run = "Yes. He went home early. It rained all that day and the roads were under water. Nobody spoke. Then it was over."
    rows = [(1, "First document.\n" + run + "\nIts own end."), (2, "Another start here.\n" + run + "\nYes. Another end altogether."),
            (3, "One. Two. Three. Yes. Nobody spoke."), (4, "Go on. " * 12)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    spans = unit_dedup.removed(df)
    texts = {r.doc_id: " ".join(r.text.split()) for r in unit_dedup.cleaned(df, spans).collect()}
    assert texts[1] == " ".join(rows[0][1].split()) and texts[3] == rows[2][1]
    assert texts[2] == "Another start here. Yes. Another end altogether."
    assert texts[4] == "Go on. Go on. Go on. Go on."
    assert {(r.doc_id, r.keep_doc_id) for r in spans.collect()} == {(2, 1), (4, 4)}
