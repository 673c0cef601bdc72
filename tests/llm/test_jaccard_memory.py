"""What a task of the Jaccard join holds."""

import random
import tracemalloc

import numpy as np
import pyarrow as pa

from marquee.llm import jaccard
from marquee.llm.text_arrow import slices


def test_repeated_against_unique():
    rng = np.random.default_rng(3)
    for n in (0, 1, 2, 5, 400):
        for least in (2, 3, 7):
            tokens = rng.integers(0, 60, n).astype(np.uint64)
            values, counts = np.unique(tokens, return_counts=True)
            found, times = jaccard.repeated(tokens.copy(), least)
            assert found.tolist() == values[counts >= least].tolist()
            assert times.tolist() == counts[counts >= least].tolist()


def test_counting_a_chunk_makes_no_copies():
    tokens = np.random.default_rng(3).integers(0, 1 << 40, 1 << 20).astype(np.uint64)
    tracemalloc.start()
    jaccard.repeated(tokens, 2)
    _, peak = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert peak < tokens.nbytes


def test_shingling_a_batch_of_texts_is_bounded():
    rng = random.Random(3)
    words = ["w%d" % i for i in range(500)]
    batch = pa.RecordBatch.from_pydict({"text": [" ".join(rng.choices(words, k=400)) for _ in range(2000)]})
    shingler = jaccard.Shingler()
    tracemalloc.start()
    for own in slices(iter([batch]), "text", jaccard.SLICE_BYTES):
        shingler(own.column("text"))
    _, peak = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert peak < 40 << 20


def _resident_mb() -> float:
    with open("/proc/self/statm") as f:
        return int(f.read().split()[1]) * 4096 / 2**20


def test_memory_that_is_done_with_goes_back():
    """Fails where only Arrow's memory goes back after the last batch."""
    batch = pa.RecordBatch.from_pydict({"text": ["a", None]})
    read = slices(iter([batch]), "text", 100)
    next(read)
    held = [np.ones(8000) for _ in range(3000)]  # 190 MB in pieces below the size of a mapping of their own
    kept = held[::100]
    full = _resident_mb()
    del held
    assert list(read) == []
    assert len(kept) == 30 and _resident_mb() < full - 120


def test_little_in_common_is_not_compared(spark, monkeypatch):
    """Documents that share a passage, but too little of it to link, are no
    pairs of a star and a centre; tables that nothing reads are deleted."""
    import glob

    from marquee.session import ensure_checkpoint_dir
    names, own = [], jaccard.materialize
    monkeypatch.setattr(jaccard, "materialize", lambda df, name: (names.append(name), own(df, name))[1])
    rng = random.Random(5)

    def words(n: int) -> str:
        return " ".join("w%x" % rng.getrandbits(48) for _ in range(n))
    rows = []
    for i in range(40):
        shared = words(14)
        rows += [(2 * i, f"{words(90)} {shared} {words(90)}"), (2 * i + 1, f"{words(90)} {shared} {words(90)}")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert all(r.component_id == r.doc_id for r in jaccard.near_duplicates(docs).collect())
    assert "jaccard-pairs" in names and "jaccard-contents" not in names
    text = words(100)
    docs = spark.createDataFrame([(101, text), (102, f"{text} end"), *rows[2:]], "doc_id long, text string")
    folder = ensure_checkpoint_dir(spark).removeprefix("file:") + "/marquee-staging/jaccard-contents-*"
    before = set(glob.glob(folder))
    names.clear()
    assert {r.doc_id: r.component_id for r in jaccard.near_duplicates(docs).filter("doc_id > 100").collect()} == {101: 101, 102: 101}
    assert "jaccard-contents" in names and set(glob.glob(folder)) == before


def test_sketches_differ_in_no_more_than_the_sets():
    rng = np.random.default_rng(8)
    for n, m, common in ((0, 3, 0), (1, 1, 0), (300, 300, 260), (255, 260, 255), (900, 300, 300), (40_000, 30_000, 29_000)):
        every = np.unique(rng.integers(0, 1 << 63, n + m, dtype=np.uint64))
        rng.shuffle(every)
        x, y = every[:n], every[n - common:n - common + m]
        if common == 0:
            y = every[n:n + m]
        found = jaccard.differing(*(np.frombuffer(jaccard.sketch(z), np.uint8) for z in (x, y)))
        assert found <= len(np.setxor1d(x, y)) and found % 2 == len(np.setxor1d(x, y)) % 2


def test_a_family_below_the_threshold_is_not_compared_whole(spark, monkeypatch):
    """Many copies of one text, each changed so much that no two link, though
    their prefixes do not tell: few pairs go to the whole sets."""
    compared, own = [], jaccard.materialize

    def counted(df, name):
        out = own(df, name)
        if name == "jaccard-pairs":
            compared.append(out.count())
        return out
    monkeypatch.setattr(jaccard, "materialize", counted)
    rng = random.Random(6)
    base = ["b%d" % i for i in range(300)]
    rows = []
    for i in range(30):
        words = list(base)
        for place in rng.sample(range(5, 295, 5), 7):
            words[place] = "c%d_%d" % (i, place)
        rows.append((i, " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert all(r.component_id == r.doc_id for r in jaccard.near_duplicates(docs).collect())
    assert sum(compared) < 40, compared


def test_pairs_of_a_large_family_are_no_rows(spark, monkeypatch):
    """Each set of a family goes to a few blocks in which it is compared; the
    pairs of the family are in no table, with large blocks cut or not."""
    rng = random.Random(9)
    base = ["b%d" % i for i in range(300)]
    rows = []
    for i in range(150):
        words = list(base)
        for place in rng.sample(range(5, 295, 5), 7):
            words[place] = "c%d_%d" % (i, place)
        rows.append((i, " ".join(words)))
    rows += [(1000 + i, f"{rows[i][1]} another end") for i in range(0, 150, 10)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    for large in (jaccard.LARGE_GROUP, 40):
        monkeypatch.setattr(jaccard, "LARGE_GROUP", large)
        tables, own = {}, jaccard.materialize

        def counted(df, name, tables=tables, own=own):
            out = own(df, name)
            tables[name] = max(tables.get(name, 0), out.count())
            return out
        monkeypatch.setattr(jaccard, "materialize", counted)
        found = {r.doc_id: r.component_id for r in jaccard.near_duplicates(docs).collect()}
        monkeypatch.setattr(jaccard, "materialize", own)
        assert found == {i: i - 1000 if i >= 1000 else i for i, _ in rows}
        pairs = {name: n for name, n in tables.items() if name in ("jaccard-tried", "jaccard-pairs", "jaccard-dealt", "jaccard-links")}
        assert pairs and max(pairs.values()) < 4 * len(rows), pairs


def test_close_in_blocks_against_all_pairs():
    rng = np.random.default_rng(4)
    rows, sets = [], {}
    for block in range(12):
        base = rng.integers(0, 1 << 63, 60 if block < 8 else 700, dtype=np.uint64)
        for _ in range(int(rng.integers(1, 30))):
            gone = int(rng.integers(0, len(base) // 2))
            mine = np.unique(np.concatenate((base[gone:], rng.integers(0, 1 << 63, int(rng.integers(0, 20)), dtype=np.uint64))))
            sid = len(sets)
            sets[sid] = mine
            rows.append((block, sid, len(mine), int(rng.integers(0, 20)), bool(rng.integers(0, 4)), int(rng.integers(0, 2)) if block % 2 else -1, jaccard.sketch(mine)))
    rows.sort(key=lambda r: (r[0], r[2], not r[4]))
    wanted = set()
    for i, x in enumerate(rows):
        for y in rows[i + 1:]:
            fits = x[0] == y[0] and x[3] != y[3] and x[4] and (x[5] < 0 or x[5] != y[5]) and 100 * x[2] >= 75 * y[2]
            if fits and jaccard.differing(np.frombuffer(x[6], np.uint8), np.frombuffer(y[6], np.uint8)) <= jaccard.most_differing(x[2], y[2], 75):
                wanted.add((x[0], min(x[1], y[1]), max(x[1], y[1])))
    names = ["block", "sid", "n", "root", "own", "side", "sketch"]
    for size in (1, 7, 1000):
        batches = [pa.RecordBatch.from_pydict(dict(zip(names, map(list, zip(*rows[i:i + size]))))) for i in range(0, len(rows), size)]
        found = [(r["block"], r["a"], r["b"]) for b in jaccard.close_in_blocks(iter(batches), 75) for r in b.to_pylist()]
        assert len(found) == len(set(found)) and set(found) == wanted and len(wanted) > 100


def test_rows_of_a_slice_as_single_sets():
    rng = np.random.default_rng(6)
    sizes = [0, 1, 2, 300, 0, 256, 257, 40_000, 5, 0]
    rows = [rng.integers(0, 50 if n == 5 else 1 << 64, n, dtype=np.uint64) for n in sizes]
    to = np.concatenate(([0], np.cumsum(sizes)))
    tokens, ends = jaccard.distinct(np.concatenate(rows), to)
    own = [np.unique(r) for r in rows]
    assert [x.tolist() for x in np.split(tokens, ends[1:-1])] == [x.tolist() for x in own]
    assert jaccard.set_ids(tokens, ends).tolist() == [jaccard.set_id(x) for x in own]
    assert jaccard.sketches(tokens, ends).to_pylist() == [jaccard.sketch(x) for x in own]
    tokens, ends = jaccard.distinct(np.zeros(0, np.uint64), np.zeros(3, np.int64))
    assert len(tokens) == 0 and jaccard.set_ids(tokens, ends).tolist() == [0, 0] and jaccard.sketches(tokens, ends).to_pylist() == [jaccard.sketch(tokens)] * 2
