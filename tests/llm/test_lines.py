import hashlib

import pytest
from helpers import EDGES, table

from marquee.llm import lines


def plain(rows, m=2):
    """doc -> remaining lines, for rows with different ids."""
    rows = sorted(((i if i is not None else -1 << 70, t) for i, t in rows if t is not None))
    seen, out = {}, {}
    cut = [(i, t.split("\n")) for i, t in rows]
    for i, own in cut:
        for k in range(len(own) - m + 1):
            seen.setdefault(tuple(own[k:k + m]), (i, k))
    for i, own in cut:
        gone = set()
        for k in range(len(own) - m + 1):
            if seen[tuple(own[k:k + m])] != (i, k):
                gone.update(range(k, k + m))
        out[i] = [x for k, x in enumerate(own) if k not in gone]
    return out


ROWS = [(1, "a\nb\nc\nd"), (2, "x\na\nb\nc\ny"), (3, "a\nb\na\nb\na\nb"), (4, "q\na\nz"), (5, "a\nb\nc\nd"),
        (6, "\n\n\n\n"), (7, ""), (8, "a"), (9, "c\nd\ne\nf\ng\nh\ni"), (10, "d\ne\nf\ng\nh\ni\nj")]


@pytest.mark.parametrize("m", [1, 2, 3, 5])
def test_against_plain(spark, m):
    got = {r["doc_id"]: r for r in lines.dedup_lines(table(spark, ROWS), m).collect()}
    want = plain(ROWS, m)
    for i, t in ROWS:
        assert got[i]["text"] == "\n".join(want[i])
        assert got[i]["line_count"] == len(t.split("\n"))
        assert got[i]["removed_lines"] == len(t.split("\n")) - len(want[i])


def test_longest_shared_prefix(spark):
    got = {r["doc_id"]: r["longest_shared"] for r in lines.dedup_lines(table(spark, ROWS)).collect()}
    assert got[5] == 4 and got[10] == 4 and got[1] == 0  # by whole doublings; the first copy has nothing to delete


def test_edges(spark):
    df = table(spark, EDGES, extra=("line_count", "rank", "first", "doc", "content", "start"))
    got = lines.dedup_lines(df).collect()
    assert len(got) == len(EDGES)
    by = [(r["doc_id"], r["text"]) for r in got]
    assert (1, None) in by and (2, "") in by
    assert by.count((7, "same\nlines\nhere")) == 2 and (8, "") in by  # repeated rows are one document
    assert all(r["rank"] == "clash" and r["line_count"] != "clash" for r in got)
    none = next(r for r in got if r["doc_id"] == 1)
    assert (none["line_count"], none["removed_lines"]) == (0, 0)


def test_empty(spark):
    assert lines.dedup_lines(table(spark, [])).collect() == []


def test_hot_run(spark):
    rows = [(i, f"own {i}\nhot one\nhot two\nother {i}") for i in range(300)]
    got = {r["doc_id"]: r["text"] for r in lines.dedup_lines(table(spark, rows)).collect()}
    assert got[0] == rows[0][1] and all(got[i] == f"own {i}\nother {i}" for i in range(1, 300))


def test_main_path_has_no_python(spark):
    plan = lines.dedup_lines(table(spark, ROWS))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_digest_of_kept_text():
    assert hashlib.sha256(b"").hexdigest().startswith("e3b0c442")


def test_long_single_lines(spark):
    long, other = " ".join(f"w{i}" for i in range(50)), "  ".join(f"v{i}" for i in range(50))
    short = " ".join(f"w{i}" for i in range(49)) + " " * 60
    rows = [(1, f"a\n{long}\nb"), (2, f"c\n{long}\nd\n{short}"), (3, long), (4, long), (5, f"{short}\ne\n{other}"),
            (6, f"{other}\nf\n{other}\ng"), (7, f"a\n{long}\nx\n{long}\n{other}\ny"), (8, f"c\n{long}\nd")]
    got = {r["doc_id"]: r for r in lines.dedup_lines(table(spark, rows), min_words=lines.LONG_WORDS).collect()}
    assert {i: r["text"] for i, r in got.items()} == {
        1: rows[0][1], 2: f"c\nd\n{short}", 3: "", 4: "", 5: rows[4][1], 6: "f\ng", 7: "x\ny", 8: ""}
    assert [(got[i]["removed_lines"], got[i]["removed_runs"]) for i in (3, 6, 7, 8)] == [(1, 1), (2, 2), (4, 2), (3, 1)]
