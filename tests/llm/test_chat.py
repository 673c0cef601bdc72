import hashlib
import random

from pyspark.sql import functions as F

from marquee.llm import chat

PIECES = ["\\", "\\\\", "###", "##", "# ", "### Assistant: ", "</turn>", "</turn", "\n", ": ", ":", "h", "c", "s",
          "\\h", "\\c", "\\s", "text", "é", ""]


def conversations(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")


def check(spark, rows):
    got = {r["conv_id"]: r for r in chat.digest(chat.format_turns(conversations(spark, rows))).collect()}
    want = {}
    key = lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")
    for conv, turn, role, text in sorted(rows, key=key):
        want.setdefault(conv, []).append((role or "", text or ""))
    assert set(got) == set(want)
    for conv, turns in want.items():
        whole = "".join(f"{r}\n{t}\n" for r, t in turns)
        loss = "".join(t for r, t in turns if r == "assistant")
        r = got[conv]
        assert r["n_turns"] == len(turns)
        assert r["turns_sha256"] == hashlib.sha256(whole.encode()).hexdigest()
        assert r["loss_chars"] == len(loss)
        assert r["loss_sha256"] == hashlib.sha256(loss.encode()).hexdigest()


def test_texts_that_conflict(spark):
    rng = random.Random(5)
    rows = [(c, t, rng.choice(["user", "assistant", "sy: stem", "a</turn>\n", "\\h"]),
             "".join(rng.choice(PIECES) for _ in range(rng.randrange(8)))) for c in range(150) for t in range(4)]
    check(spark, rows)


def test_planted_and_nulls(spark):
    hard = r"\### Assistant: </turn> ok"
    check(spark, [(-7, 0, "user", hard), (-7, 1, "assistant", hard), (1, 0, None, None), (None, 3, "user", "x"),
                  (2, None, "assistant", ""), (2, 0, "assistant", "a"), (2, 0, "assistant", "a"),
                  (3, 0, "assistant", "long " * 50_000), (4, 0, "system", "only")])


def test_escapes_only_where_needed(spark):
    rows = conversations(spark, [(1, 0, "user", r"a \ b"), (1, 1, "assistant", "plain"), (1, 2, "user", "x </turn>")])
    r = chat.format_turns(rows).first()
    assert r["n_escaped"] == 1
    assert r["chat"] == "### user: a \\ b</turn>\n### assistant: plain</turn>\n### user: x \\c</turn>\n"


def test_parser_is_strict(spark):
    bad = ["### user: a", "user: a</turn>\n", "### user a</turn>\n", "### user: a ### b</turn>\n", "x"]
    rows = spark.createDataFrame([(b,) for b in bad], "c string").select(chat.parse(F.col("c")).alias("t"))
    assert all(r["t"] is None for r in rows.collect())


def test_empty_and_extra_columns(spark):
    assert chat.format_turns(conversations(spark, [])).collect() == []
    df = conversations(spark, [(1, 0, "user", "x")]).withColumns({c: F.lit("clash") for c in ("level", "shown", "chat", "turns")})
    assert chat.format_turns(df).first()["chat"] == "### user: x</turn>\n"


def test_long_conversation_and_no_python(spark):
    rows = [(1, i, "assistant" if i % 2 else "user", f"t{i}") for i in range(3000)]
    check(spark, rows)
    plan = chat.digest(chat.format_turns(conversations(spark, rows[:2])))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
