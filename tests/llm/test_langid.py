import math
import re
from collections import Counter

from helpers import EDGES, table
from pyspark.sql import functions as F

from marquee.llm import langid
from marquee.llm.queries import op3_language_id

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = op3_language_id(spark, SF).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert len(got) == docs.count()
    out = [r for r in got if r["held_out"]]
    assert len(out) > 200 and sum(r["lang_pred"] == r["lang"] for r in out) >= 0.98 * len(out)
    assert all(0 <= r["score"] <= 1 for r in got)


def small(spark):
    rows = [("the cat sat on the mat and the dog", "en"), ("der hund und die katze auf der matte", "de"),
            ("the house and the tree", "en"), ("das haus und der baum", "de"), (None, "fr"), ("nothing", None)]
    return langid.fit(spark.createDataFrame(rows, "text string, lang string"))


def test_against_plain(spark):
    model = small(spark)
    assert model.langs == ["de", "en"]
    words = {"en": Counter("the cat sat on the mat and the dog the house and the tree".split()),
             "de": Counter("der hund und die katze auf der matte das haus und der baum".split())}
    every = set(words["en"]) | set(words["de"])
    total = {k: sum(c.values()) + 0.5 * len(every) for k, c in words.items()}
    grams = {k: Counter() for k in words}
    for k, c in words.items():
        for w, n in c.items():
            p = f" {w} "
            for size in range(1, 5):
                for i in range(max(len(p) - size + 1, 1)):
                    grams[k][p[i:i + size]] += n
    known = set(grams["en"]) | set(grams["de"])
    sums = {(k, n): sum(c[g] + 0.5 for g in known if len(g) == n) for k, c in grams.items() for n in range(1, 5)}

    def score(w, k):
        if w in every:
            return math.log((words[k][w] + 0.5) / total[k])
        p = f" {w} "
        for n in range(min(4, len(p)), 0, -1):
            own = [g for i in range(len(p) - n + 1) if (g := p[i:i + n]) in known and g != " "]
            if own:
                return sum(math.log((grams[k][g] + 0.5) / sums[k, n]) for g in own) / len(own)
        return 0.0

    texts = ["the hund", "Katzen und Bäume", "catsy dogs sitting", "zzz", "x1y2 the!", "the der"]
    rows = table(spark, list(enumerate(texts)))
    for r in langid.predict(rows, model).collect():
        found = re.findall(r"[^\W\d_]+", texts[r["doc_id"]].lower())
        want = {k: sum(score(w, k) for w in found) for k in ("de", "en")}
        best = max(want, key=lambda k: (want[k], k == "de"))
        assert r["lang_pred"] == best
        assert abs(r["score"] - math.exp(want[best]) / sum(math.exp(v) for v in want.values())) < 1e-9


def test_edges(spark):
    df = table(spark, [*EDGES, (20, "²³ 12 _ !!")], extra=("lang_pred", "score", "rank"))
    got = langid.predict(df, small(spark)).collect()
    assert len(got) == len(EDGES) + 1
    for r in got:
        if r["doc_id"] in (1, 2, 3, 10, 20):
            assert (r["lang_pred"], r["score"]) == ("und", 0.0)
        else:
            assert r["lang_pred"] in ("de", "en")
        assert r["rank"] == "clash"


def test_nothing_learned_and_empty(spark):
    none = langid.fit(spark.createDataFrame([(None, "en"), ("x", None)], "text string, lang string"))
    assert [r["lang_pred"] for r in langid.predict(table(spark, [(1, "text")]), none).collect()] == ["und"]
    assert langid.predict(table(spark, []), small(spark)).collect() == []


def test_forgetting_changes_nothing(spark):
    model = small(spark)
    a, b = langid.Scorer(model, keep=0), langid.Scorer(model)
    texts = ["catsy dogs", "mattes haus", "treehouse", "catsy dogs"] * 3
    assert [a.batch([t]) for t in texts] == [b.batch([t]) for t in texts]


def test_held_out_column(spark):
    import zlib
    rows = spark.range(50).select(F.col("id").alias("doc_id"), langid.held_out().alias("h")).collect()
    assert all(r["h"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in rows)
