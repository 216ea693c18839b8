"""Readers over layouts that are written on the spot."""

import json
import struct
import zlib

import numpy as np
import pytest

from loamstack.operators import imaging
from loamstack.sources import readers
from loamstack.streaming import checks


def png(path, pixels, palette=False):
    pixels = np.asarray(pixels, np.uint8)
    h, w = pixels.shape
    chunk = lambda k, d: struct.pack(">I", len(d)) + k + d + struct.pack(">I", zlib.crc32(k + d))
    table = chunk(b"PLTE", bytes(imaging.voc_palette().astype(np.uint8).ravel())) if palette else b""
    body = b"".join(b"\0" + r.tobytes() for r in pixels)
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", w, h, 8, 3 if palette else 0, 0, 0, 0)) + table + chunk(b"IDAT", zlib.compress(body)) + chunk(b"IEND", b""))


def blob(value=255):
    m = np.zeros((64, 64), np.uint8)
    m[10:30, 20:40] = value
    return m


def test_png_filters_and_sizes(tmp_path):
    png(tmp_path / "a.png", blob(7), palette=True)
    data = (tmp_path / "a.png").read_bytes()
    assert imaging.image_size(data) == (64, 64) and (imaging.decode_png(data) == blob(7)).all()
    rgb = imaging.voc_palette()[blob(3)]
    assert (imaging.class_indices(rgb) == blob(3)).all()
    assert imaging.image_size(b"nothing") is None


def test_directories(spark, tmp_path):
    for i in range(3):
        png(tmp_path / f"screw/train/good/{i}.png", np.zeros((64, 64)))
    for i in range(2):
        png(tmp_path / f"screw/test/thread_side/{i}.png", np.zeros((64, 64)))
    png(tmp_path / "screw/ground_truth/thread_side/0_mask.png", blob())
    rows = readers.read(spark, "directories", root=str(tmp_path)).collect()
    assert len(rows) == 5 and sum(r["label"] == "anomalous" for r in rows) == 2
    by = {r["image_path"]: r for r in rows}
    assert by["screw/test/thread_side/0.png"]["defects"][0]["bbox"] == [20, 10, 40, 30] and by["screw/test/thread_side/0.png"]["defects"][0]["type"] == "thread_damage"
    assert by["screw/test/thread_side/1.png"]["defects"][0]["bbox"] is None


def test_coco(spark, tmp_path):
    doc = {"images": [{"id": i, "file_name": f"{i}.jpg", "width": 100, "height": 80} for i in range(3)],
           "annotations": [{"id": 1, "image_id": 1, "category_id": 1, "bbox": [1, 2, 10, 10]}, {"id": 2, "image_id": 2, "category_id": 0, "bbox": [1, 2, 3, 4]}, {"id": 3, "image_id": 1, "category_id": 9, "bbox": [5, 5, 5, 5]}],
           "categories": [{"id": 0, "name": "parts", "supercategory": "none"}, {"id": 1, "name": "crack", "supercategory": "parts"}]}
    (tmp_path / "train").mkdir()
    (tmp_path / "train/_annotations.coco.json").write_text(json.dumps(doc))
    rows = {r["image_path"]: r for r in readers.read(spark, "coco", root=str(tmp_path)).collect()}
    assert len(rows) == 3 and rows["train/0.jpg"]["label"] == "normal" and rows["train/2.jpg"]["label"] == "normal"
    assert [(d["type"], d["bbox"]) for d in rows["train/1.jpg"]["defects"]] == [("crack", [1, 2, 11, 12]), ("other_anomaly", [5, 5, 10, 10])]


def test_yolo_and_masks(spark, tmp_path):
    png(tmp_path / "y/images/a.png", np.zeros((100, 200)))
    (tmp_path / "y/labels").mkdir()
    (tmp_path / "y/labels/a.txt").write_text("0 0.5 0.5 0.2 0.4\n1 0.1\n5 0.5 0.5 0.1 0.1\n")
    row = readers.read(spark, "yolo", root=str(tmp_path / "y"), names=["dent"]).first()
    assert [(d["raw"], d["bbox"]) for d in row["defects"]] == [("dent", [80, 30, 120, 70]), ("class_5", [90, 45, 110, 55])]
    png(tmp_path / "m/images/a.png", np.zeros((64, 64)))
    png(tmp_path / "m/masks/a.png", blob(2))
    row = readers.read(spark, "masks", root=str(tmp_path / "m"), class_map={2: "fair"}).first()
    assert [(d["raw"], d["type"], d["bbox"], d["grade"], d["severity"]) for d in row["defects"]] == [("fair", "corrosion", [20, 10, 40, 30], "fair", "major")]
    m = blob(4)
    m[50:60, 50:60] = 7
    png(tmp_path / "g/images/a.png", np.zeros((64, 64)))
    png(tmp_path / "g/masks/a.png", m)
    row = readers.read(spark, "masks", root=str(tmp_path / "g"), class_map={4: "severe", 0: "good"}, background=(7,), grade_type="corrosion").first()
    assert {(d["grade"], d["severity"], tuple(d["bbox"])) for d in row["defects"]} == {("severe", "critical", (20, 10, 40, 30)), ("good", "minor", (0, 0, 64, 64))}


@pytest.mark.parametrize("shape", ["split", "list", "other"])
def test_manifests(spark, tmp_path, shape):
    for i in range(2):
        png(tmp_path / f"pcb/{i}.png", np.zeros((64, 64)))
    items = [{"image_path": "0.png" if shape == "list" else "pcb/0.png", "anomaly_class": "OK", "category": "pcb"}, {"image": "pcb/1.png", "anomaly_class": "HS", "category": "pcb"}]
    doc = {"split": {"train": items[:1], "test": items[1:]}, "list": items, "other": {"meta": {"x": 1}, "samples": items}}[shape]
    (tmp_path / "pcb.json").write_text(json.dumps(doc, indent=2 if shape == "split" else None))
    rows = {r["image_path"]: r for r in readers.read(spark, "json", root=str(tmp_path)).collect()}
    assert rows["pcb/0.png"]["label"] == "normal" and rows["pcb/1.png"]["defects"][0]["type"] == "scratch"


def test_csv_and_jsonl(spark, tmp_path):
    for i in range(2):
        png(tmp_path / f"d/{i}.png", np.zeros((64, 64)))
    png(tmp_path / "g/1.png", blob())
    (tmp_path / "m.csv").write_text("object,split,label,image,mask\npcb,train,normal,d/0.png,\npcb,test,anomaly,d/1.png,g/1.png\n")
    rows = {r["image_path"]: r for r in readers.read(spark, "csv", path=str(tmp_path / "m.csv"), root=str(tmp_path), hints={"pcb": "bent"}).collect()}
    assert rows["d/0.png"]["label"] == "normal" and rows["d/1.png"]["defects"][0]["type"] == "dent" and rows["d/1.png"]["defects"][0]["bbox"] == [20, 10, 40, 30]
    (tmp_path / "r.jsonl").write_text('{"a": 1, "zz": 2}\n\n{"a": 2}\n{"a": 3')
    assert sorted(r["a"] for r in readers.read(spark, "jsonl", path=str(tmp_path / "r.jsonl"), schema="a int").collect()) == [1, 2]
    with pytest.raises(KeyError):
        readers.read(spark, "nothing")


def test_stream_of_records(spark, tmp_path):
    (tmp_path / "in").mkdir()
    good = {"task": "description", "question": "q", "answer": "a", "output_format": "text", "image": "i", "at": "2024-01-01T00:00:00"}
    (tmp_path / "in/a.json").write_text("\n".join(json.dumps(x) for x in (good, good, good | {"answer": "{obj}"}, good | {"answer": "b"})))
    stream = checks.read_records(spark, str(tmp_path / "in"), "task string, question string, answer string, output_format string, image string, at timestamp")
    checks.write(checks.passing(stream, "at"), str(tmp_path / "out"), str(tmp_path / "ck")).awaitTermination()
    assert sorted(r["answer"] for r in spark.read.parquet(str(tmp_path / "out")).collect()) == ["a", "b"]


def bmp(path, pixels, up=True):
    pixels = np.asarray(pixels, np.uint8)
    h, w = pixels.shape
    rows = np.zeros((h, (w + 3) // 4 * 4), np.uint8)
    rows[:, :w] = pixels[::-1] if up else pixels
    head = struct.pack("<IiiHHIIiiII", 40, w, h if up else -h, 1, 8, 0, rows.size, 0, 0, 256, 0)
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(b"BM" + struct.pack("<IHHI", 54 + 1024 + rows.size, 0, 0, 54 + 1024) + head + bytes(1024) + rows.tobytes())


def test_bmp_masks_and_broken_ones(spark, tmp_path):
    for i in range(5):
        png(tmp_path / f"screw/test/thread_side/{i}.png", np.zeros((64, 64)))
    masks = tmp_path / "screw/ground_truth/thread_side"
    bmp(masks / "0_mask.bmp", blob())
    bmp(masks / "1.bmp", blob(), up=False)
    png(masks / "2_mask.png", blob())
    (masks / "2_mask.png").write_bytes((masks / "2_mask.png").read_bytes()[:60])
    bmp(masks / "2_mask.bmp", blob(9)[:, ::-1])
    (masks / "3_mask.png").write_bytes(b"nothing")
    bmp(masks / "4" / "0.bmp", blob())
    png(masks / "4" / "1.png", blob().T)
    (masks / "4" / "2.png").write_bytes(b"\x89PNG\r\n\x1a\n")
    boxes = {r["image_path"][-5]: [d["bbox"] for d in r["defects"]] for r in readers.directories(spark, str(tmp_path)).collect()}
    assert {k: sorted(v, key=str) for k, v in boxes.items()} == {"0": [[20, 10, 40, 30]], "1": [[20, 10, 40, 30]], "2": [[24, 10, 44, 30]], "3": [None], "4": [None, [10, 20, 30, 40], [20, 10, 40, 30]]}
    assert sorted(r["path"].split("/")[-1] for r in readers.unread_masks(spark, str(tmp_path)).collect()) == ["2.png", "2_mask.png", "3_mask.png"]
    rgb = np.zeros((2, 3, 3), np.uint8)
    rgb[0, 1] = (1, 2, 3)
    rows = np.zeros((2, 12), np.uint8)
    rows[:, :9] = rgb[::-1, :, ::-1].reshape(2, 9)
    data = b"BM" + struct.pack("<IHHI", 0, 0, 0, 54) + struct.pack("<IiiHHIIiiII", 40, 3, 2, 1, 24, 0, 0, 0, 0, 0, 0) + rows.tobytes()
    assert (imaging.decode(data) == rgb).all() and imaging.decode(b"BM") is None and imaging.decode(data[:50]) is None


@pytest.mark.parametrize("text, names", [
    ("names: ['crack', dent]\nnc: 2\n", ["crack", "dent"]), ("nc: 2\nnames:\n  - crack  # first\n  - 'oil leak'\ntrain: x\n", ["crack", "oil leak"]), ("names:\n- a\n- b\nval: y", ["a", "b"]),
    ("names:\n  1: dent\n  0: \"crack\"\n", ["crack", "dent"]), ("names: {0: a, 1: b}\n", ["a", "b"]), ("path: x\n", []), ("names: [a,\n  b]\n", ["a", "b"]),
])
def test_yolo_names(spark, tmp_path, text, names):
    (tmp_path / "data.yaml").write_text(text)
    assert readers.yolo_names(spark, str(tmp_path)) == names


def test_yolo_finds_its_names(spark, tmp_path):
    png(tmp_path / "images/a.png", np.zeros((100, 200)))
    (tmp_path / "labels").mkdir()
    (tmp_path / "labels/a.txt").write_text("1 0.5 0.5 0.2 0.4\n")
    (tmp_path / "dataset.yaml").write_text("names: [crack, dent]")
    assert readers.read(spark, "yolo", root=str(tmp_path)).first()["defects"][0]["raw"] == "dent"
