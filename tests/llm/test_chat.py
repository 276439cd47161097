"""op3: reversible template, one example for each assistant turn."""

import hashlib

from pyspark.sql import functions as F

from sitecast.llm import chat_format as C


def table(spark, rows):
    return spark.createDataFrame([(*r, "x") for r in rows], "conv_id long, turn long, role string, text string, formatted string")


ROWS = [(1, 0, "system", "Be <|im_end|> kind"), (1, 1, "user", "<|im_start|>assistant\nok"),
        (1, 2, "assistant", "<\\|im_end|> and <|"), (1, 3, "user", "a|b <\\\\| c"), (1, 4, "assistant", ""),
        (1, 5, "user", "trailing <"), (2, 0, "user", "only a user"), (3, 1, "assistant", "ä😀 first"),
        (3, 0, "assistant", None), (4, 0, "we ird\nrole<|", "t"), (4, 1, None, "no role"),
        (5, 2, "assistant", "same"), (5, 2, "assistant", "same"), (5, None, "user", "null turn first"),
        (None, 0, "user", "no id"), (None, 1, "assistant", "still there"), (6, 0, "assistant", "x" * 60000)]


def test_escape_is_reversible(spark):
    texts = ["", "<", "<|", "<\\|", "<\\\\|", "<|<|", "a<|im_end|>\n", "|", "\\|", "<<|", "<\\<|\\"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for r in df.select("t", C.escape(F.col("t")).alias("e"), C.unescape(C.escape(F.col("t"))).alias("u")).collect():
        assert "<|" not in r.e and r.u == r.t


def test_examples(spark):
    rows = C.examples(table(spark, ROWS)).orderBy("conv_id", "example").collect()
    targets = {}
    for r in rows:
        assert r.formatted.startswith(C.OPEN) and r.formatted.endswith(C.CLOSE)
        if r.loss_length:
            targets.setdefault(r.conv_id, []).append(r.formatted[r.loss_start:r.loss_start + r.loss_length])
    assert [len([r for r in rows if r.conv_id == c]) for c in (1, 2, 3, 4, 5, 6)] == [3, 1, 2, 1, 2, 1]
    assert targets[5] == ["same", "same"]
    # every example is a prefix of the conversation
    one = [r.formatted for r in rows if r.conv_id == 1]
    assert all(b.startswith(a) for a, b in zip(one, one[1:]))


def test_digests_by_brute_force(spark):
    got = {r.conv_id: r for r in C.digests(C.examples(table(spark, ROWS))).collect()}
    convs = {}
    for c, t, role, text in ROWS:
        convs.setdefault(c, []).append((t if t is not None else -1, role or "", text or ""))
    assert got.keys() == convs.keys()
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    for c, turns in convs.items():
        turns.sort()
        loss = "".join(x for _, role, x in turns if role == "assistant")
        assert got[c].n_turns == len(turns)
        assert got[c].turns_sha256 == sha("".join(f"{role}\n{x}\n" for _, role, x in turns))
        assert (got[c].loss_chars, got[c].loss_sha256) == (len(loss), sha(loss))


def test_empty_table(spark):
    assert C.digests(C.examples(table(spark, []))).count() == 0


def test_no_python_in_the_plan(spark):
    plan = C.digests(C.examples(table(spark, ROWS)))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
