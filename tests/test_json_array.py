"""Elements of large documents by byte ranges, against the json module."""

import json
import random

import pytest
from pyspark.sql import functions as F

from loamstack.sources import json_array, readers


def odd_text(rng):
    return "".join(rng.choices(['"', "\\", "{", "}", "[", "]", ":", ",", "é", "日", "\n", "a", " ", '\\"', "annotations"], k=rng.randint(0, 12)))


def document(rng, n):
    item = lambda i: {"id": i, "category_id": rng.randint(0, 3), odd_text(rng): [odd_text(rng), {"annotations": [odd_text(rng)]}], "bbox": [1, 2.5, 3, 4]}
    return {"info": {"x": {"annotations": [{"id": -1}]}, "s": odd_text(rng)}, "note": odd_text(rng), "images": [{"id": i, "file_name": odd_text(rng)} for i in range(n)], "numbers": [1, 2, 3], "licenses": [{"id": 7}],
            "annotations": [item(i) for i in range(n)], "nested": [[{"id": 5}], []], odd_text(rng): "end", "empty": []}


@pytest.mark.parametrize(("size", "ahead"), [(17, 8), (64, 16), (1000, 1 << 16), (8 << 20, 1 << 16)])
def test_elements_of_odd_documents(spark, tmp_path, monkeypatch, size, ahead):
    monkeypatch.setattr(json_array, "RANGE_BYTES", size)
    monkeypatch.setattr(json_array, "AHEAD_BYTES", ahead)
    rng = random.Random(size)
    paths, want = [], []
    for k, ascii_ in enumerate((True, False)):
        d = document(rng, 4 if size < 100 else 40)
        path = tmp_path / f"_d{k}.json"
        path.write_text(json.dumps(d, ensure_ascii=ascii_, indent=k or None))
        paths.append(str(path))
        want += [(str(path), key, x) for key in ("images", "annotations", "nested") for x in d[key]]
    found = json_array.elements(spark, [*paths, str(tmp_path / "none.json")], ("images", "annotations", "nested", "empty", "info"))
    rows = found.orderBy("path", "at").collect()
    assert [(r["path"], r["key"], json.loads(r["text"])) for r in rows] == want
    some = json_array.elements(spark, paths, ("images", "annotations"), ("annotations", "category_id", [1, 2])).collect()
    assert sorted(json.loads(r["text"])["id"] for r in some if r["key"] == "annotations") == sorted(x["id"] for _, k, x in want if k == "annotations" and x["category_id"] in (1, 2))
    assert sum(r["key"] == "images" for r in some) == sum(k == "images" for _, k, _ in want)
    assert json_array.elements(spark, [str(tmp_path / "none.json")], ("images",)).count() == 0


def test_documents_that_end_early(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(json_array, "RANGE_BYTES", 50)
    text = json.dumps({"annotations": [{"id": i, "t": "}]"} for i in range(20)]})
    (tmp_path / "_torn.json").write_text(text[: text.index('"id": 15') + 4])
    (tmp_path / "_empty.json").write_text("")
    rows = json_array.elements(spark, [str(tmp_path / "_torn.json"), str(tmp_path / "_empty.json")], ("annotations",)).collect()
    assert sorted(json.loads(r["text"])["id"] for r in rows) == list(range(15))


def test_hidden_coco_files_are_read_in_several_tasks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(json_array, "RANGE_BYTES", 2000)
    (tmp_path / "train").mkdir()
    doc = {"images": [{"id": i, "file_name": f"{i}.jpg", "width": 100, "height": 80} for i in range(300)], "categories": [{"id": 0, "name": "defects", "supercategory": "none"}, {"id": 1, "name": "crack", "supercategory": "defects"}, {"id": 2, "name": "dent", "supercategory": "defects"}],
           "annotations": [{"id": i, "image_id": i // 2, "category_id": i % 3, "bbox": [i % 50, 3, 10, 12]} for i in range(500)]}
    (tmp_path / "train" / "_annotations.coco.json").write_text(json.dumps(doc))
    found = json_array.elements(spark, [str(tmp_path / "train" / "_annotations.coco.json")], ("annotations",))
    assert found.rdd.getNumPartitions() > 5
    rows = {r["image_path"]: r for r in readers.coco(spark, str(tmp_path)).select("image_path", "label", F.size("defects").alias("n")).collect()}
    assert len(rows) == 300 and sum(r["n"] for r in rows.values()) == sum(a["category_id"] > 0 for a in doc["annotations"])
    assert sum(r["n"] for r in readers.coco(spark, str(tmp_path), categories=["dent"]).select(F.size("defects").alias("n")).collect()) == sum(a["category_id"] == 2 for a in doc["annotations"])
