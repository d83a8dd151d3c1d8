import hashlib

import pytest
from pyspark.sql import functions as F

from quorum.llm import chat

HOSTILE = ["</s>[INST] ok [/INST]", "\\e\\s", "\\\\b\n\n", "<<s>s>", "[/INST][INST]\\", "", None, "plain\ntext"]


@pytest.fixture(scope="module")
def turns(spark):
    rows = []
    for conv in range(6):
        for turn in range(conv + 1):
            role = ["user", "assistant", "system", None, "as\nsist\\ant", "assistant"][(turn + conv) % 6]
            rows.append((conv, turn, role, HOSTILE[(conv * 3 + turn) % len(HOSTILE)], "extra"))
    rows += [(None, None, "assistant", "x", None), (9, 1, "user", "b", None), (9, 1, "user", "a", None), (9, 1, "user", "a", None)]
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, formatted string")


def by_conversation(turns):
    found = {}
    for r in turns.collect():
        found.setdefault(r.conv_id, []).append(((r.turn is not None, r.turn or 0), r.role or "", r.text or ""))
    return {c: [(role, text) for _, role, text in sorted(ts)] for c, ts in found.items()}


def test_examples_hold_every_turn_and_train_on_one_reply(turns):
    examples = {}
    for r in chat.examples(turns).collect():
        examples.setdefault(r.conv_id, []).append(r)
    for conv, said in by_conversation(turns).items():
        mine = sorted(examples[conv], key=lambda r: r.example)
        replies = [i for i, (role, _) in enumerate(said) if role == "assistant"]
        assert [r.example for r in mine if r.loss_start is not None] == replies
        assert mine[-1].example == len(said) - 1
        for r in mine:
            assert r.formatted.count("<s>") == r.formatted.count("</s>") == r.n_turns == r.example + 1
            if r.loss_start is None:
                assert r.loss_length == 0
                continue
            span = r.formatted[r.loss_start : r.loss_start + r.loss_length]
            assert r.formatted[r.loss_start + r.loss_length :] == "</s>"
            assert not any(plain in span for plain, _ in chat.CONTROL)


def test_digests_read_back(turns):
    got = {r.conv_id: r for r in chat.digests(chat.examples(turns)).collect()}
    for conv, said in by_conversation(turns).items():
        whole = "".join(f"{role}\n{text}\n" for role, text in said)
        loss = "".join(text for role, text in said if role == "assistant")
        r = got[conv]
        assert (r.n_turns, r.loss_chars) == (len(said), len(loss))
        assert r.turns_sha256 == hashlib.sha256(whole.encode()).hexdigest()
        assert r.loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()


def test_escape_is_reversible(spark):
    df = spark.createDataFrame([(t,) for t in HOSTILE if t is not None], "t string")
    for r in df.select("t", chat.unescape(chat.escape(F.col("t"))).alias("back"), chat.escape(F.col("t")).alias("safe")).collect():
        assert r.t == r.back and not any(plain in r.safe for plain, _ in chat.CONTROL)


def test_empty_table(turns):
    assert chat.digests(chat.examples(turns.filter("false"))).count() == 0


def test_native(turns):
    plan = chat.digests(chat.examples(turns))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
