"""Regions of annotation tasks."""

import json

from panelmill.sources import readers


def test_box_of_a_region_whose_first_result_has_none(spark, tmp_path):
    """A text without a box may come before the rectangle of its region; lists keep the order of the results."""
    part = lambda kind, **value: {"id": "r", "type": kind, "original_width": 100, "original_height": 100, "value": value}
    result = [part("textarea", text=["B"]), part("rectanglelabels", x=1, y=2, width=3, height=4, rectanglelabels=["Panel"]), part("textarea", text=["A"])]
    (tmp_path / "t.json").write_text(json.dumps([{"id": 1, "annotations": [{"id": 2, "was_cancelled": False, "result": result}]}]))
    r = readers.task_boxes(readers.tasks(spark, str(tmp_path / "t.json"))).first()
    assert (tuple(r.box), r.labels, r.names, r.conflict) == ((1, 2, 4, 6), ["Panel"], ["B", "A"], True)
