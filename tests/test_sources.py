"""Scripts of INSERT statements, and pointers that need no clock."""

import pytest

from starloom.plans import publish
from starloom.sources.readers import read_insert_script

SCRIPT = """TRUNCATE TABLE s.links;

INSERT INTO s.kinds (name)
 VALUES ('a; b');
INSERT INTO s.links (product_id, category_id)
 VALUES (1, 2);
insert into links ("category_id",product_id) values (7,8) , (9, NULL);
INSERT INTO s.links_old (product_id, category_id) VALUES (100, 200);
"""


def test_insert_script(spark, tmp_path):
    (tmp_path / "links.sql").write_text(SCRIPT)
    rows = read_insert_script(spark, str(tmp_path / "links.sql"), "links", ["product_id", "category_id"])
    assert sorted(map(tuple, rows.collect()), key=repr) == [(1, 2), (8, 7), (None, 9)]
    assert read_insert_script(spark, str(tmp_path / "links.sql"), "nothing", ["a"]).count() == 0
    with pytest.raises(Exception, match="without column other"):
        read_insert_script(spark, str(tmp_path / "links.sql"), "links", ["other"]).collect()
    (tmp_path / "bad.sql").write_text("insert into links (product_id, category_id) values (1, x)")
    with pytest.raises(Exception, match="CAST"):
        read_insert_script(spark, str(tmp_path / "bad.sql"), "links", ["product_id", "category_id"]).collect()


def test_pointers_go_by_number_not_by_clock(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "wh")
    with pytest.raises(ValueError, match="published"):
        publish.current_run(spark, root)
    for i, run in enumerate(("c", "a", "b"), 1):
        publish.publish_run(spark, run, root)
        assert publish.current_run(spark, root) == run
        assert publish._last(spark, root) == (i, run)
    # two drivers that saw the same last pointer: the larger run id counts for both
    monkeypatch.setattr(publish, "_last", lambda *_: (3, "b"))
    publish.publish_run(spark, "x", root)
    publish.publish_run(spark, "w", root)
    monkeypatch.undo()
    assert publish.current_run(spark, root) == "x"
