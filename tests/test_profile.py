"""Why manifests gave no rows."""

import numpy as np
from pyspark.sql import functions as F
from test_sources import png

from loamstack.sources import profile, readers


def test_profile_and_observation(spark):
    rows = [("a", {"image": "x", "label": "ok"}, "ok"), ("a", {"path": "y"}, "no_file"), ("b", {"file": "z", "image": ""}, "no_field"), ("b", {"file": "z"}, "no_field"), ("c", {"image": "q"}, "no_size"), ("c", {"image": "r"}, "no_file"), ("d", {}, "no_field")]
    df = spark.createDataFrame(rows, "source string, item map<string,string>, reason string")
    watched, seen = profile.observed(df, "reasons")
    got = {r["source"]: tuple(r)[1:] for r in profile.profile(watched, ("image", "path")).collect()}
    assert got == {"a": (2, 1, "ok", "image=1,path=1", "image=1,label=1,path=1"), "b": (2, 0, "no_field", "", "file=2,image=1"), "c": (2, 0, "no_file", "image=2", "image=2"), "d": (1, 0, "no_field", "", "")}
    watched, seen = profile.observed(df, "again")
    watched.write.format("noop").mode("overwrite").save()
    assert seen.get == {"n_items": 7, "no_field": 3, "no_file": 2, "no_size": 1, "ok": 1}
    assert spark.range(1).select(profile.first_field(F.create_map(F.lit("b"), F.lit("v"), F.lit("a"), F.lit("")), ("a", "b")).alias("f")).first()["f"] == "b"


def test_manifest_reasons(spark, tmp_path):
    png(tmp_path / "cat" / "1.png", np.zeros((4, 4)))
    (tmp_path / "cat" / "2.png").write_bytes(b"no picture")
    (tmp_path / "cat.json").write_text('{"train": [{"image_path": "1.png"}, {"image_path": "2.png"}, {"img_path": "3.png"}], "test": [{"file": "1.png"}]}')
    (tmp_path / "odd.json").write_text('[{"photo": "a"}]')
    (tmp_path / "none.json").write_text('{"meta": "x"}')
    got = {r["source"]: r for r in readers.manifest_profile(spark, str(tmp_path)).collect()}
    assert (got["cat"]["n_items"], got["cat"]["n_ok"], got["cat"]["reason"], got["cat"]["fields"]) == (4, 1, "ok", "image_path=2,img_path=1")
    assert (got["odd"]["reason"], got["odd"]["keys"], got["none"]["reason"], got["none"]["n_items"]) == ("no_field", "photo=1", "no_items", 0)
    assert readers.manifest_json(spark, str(tmp_path)).count() == 1
