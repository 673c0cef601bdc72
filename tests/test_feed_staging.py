"""The feed in E6: written once, its unreadable records kept."""

import os

import pytest

from marquee.plans import jobs as J


@pytest.mark.parametrize("broken", [0, 3])
def test_feed_is_written_once(spark, tmp_path, monkeypatch, broken):
    docs = [f"<doc><title>Wikipedia: T{i}</title><url>u{i}</url><abstract>{i}</abstract></doc>" for i in range(50)]
    docs += [f"<doc><title>Wikipedia: B{i}</title><url></doc>" for i in range(broken)]
    (tmp_path / "f.xml").write_text("<feed>\n" + "\n".join(docs) + "</feed>")
    copies = []
    monkeypatch.setattr(J, "delete_path", lambda s, path: copies.append(os.path.exists(path)))
    t = J.run_all(spark, str(tmp_path / "out"), "", [], "", str(tmp_path / "f.xml"), tables=("wiki_feed",))
    assert copies == [False]  # no annotated copy of the feed
    assert sorted(r.title for r in t.feed.collect()) == sorted(f"T{i}" for i in range(50))
    rejects = t.feed_rejects.collect()
    assert len(rejects) == broken
    assert all(r.reject_reasons == ["record:unreadable"] and r.raw_record.startswith("<doc>") and r.file for r in rejects)
