"""Readers and writers, images included."""

import json
import struct
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from spark_curate.functions import pixels as P
from spark_curate.operators import dedup, images, manifest, resolution, scoring
from spark_curate.plans import steps
from spark_curate.sources import readers, writers
from spark_curate.sources import schemas as S


def png(pixels):
    height, width, _ = pixels.shape
    raw = b"".join(b"\0" + pixels[y].tobytes() for y in range(height))

    def chunk(kind, data):
        return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))

    head = struct.pack(">IIBBBBB", width, height, 8, 2, 0, 0, 0)
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", head) + chunk(b"IDAT", zlib.compress(raw)) + chunk(b"IEND", b"")


def gradient(width, height):
    """A scene with energy in all low frequencies, at any size."""
    y, x = np.mgrid[0:height, 0:width]
    y, x = (y + 0.5) / height, (x + 0.5) / width
    rng = np.random.default_rng(1)
    wave = sum(
        rng.normal() * np.cos(np.pi * a * x) * np.cos(np.pi * b * y) for a in range(9) for b in range(9)
    )
    scene = (127 + 100 * wave / np.abs(wave).max()).clip(0, 255)
    return np.repeat(scene[:, :, None], 3, axis=2).astype(np.uint8)


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    root = tmp_path_factory.mktemp("raw images")
    noise = np.random.default_rng(0).integers(0, 256, (60, 60, 3), dtype=np.uint8)
    files = {
        "google/red_clay/a.png": png(gradient(80, 60)),
        "google/red_clay/b.PNG": png(gradient(160, 120)),
        "bing/sand/c.png": png(noise),
        "bing/sand/tiny.png": png(gradient(8, 90)),
        "bing/sand/broken.jpg": b"xx",
        "root.png": png(gradient(60, 60)),
        "notes.txt": b"no image",
    }
    for name, data in files.items():
        path = root / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(data)
    return str(root)


def test_listing(spark, folder):
    found = readers.image_files(spark, folder)
    assert "content" not in found.columns
    assert sorted(r["path"] for r in found.collect()) == [
        "bing/sand/broken.jpg", "bing/sand/c.png", "bing/sand/tiny.png",
        "google/red_clay/a.png", "google/red_clay/b.PNG", "root.png",
    ]
    assert readers.image_files(spark, folder + "/nowhere").count() == 0


def test_decode_hash_and_resize(spark, folder):
    decoded = readers.items(readers.decoded_images(spark, folder)).cache()
    sizes = {r["path"]: (r["width"], r["height"]) for r in decoded.collect()}
    assert sizes["google/red_clay/b.PNG"] == (160, 120) and sizes["bing/sand/broken.jpg"] == (None, None)
    out = steps.resize_step(decoded, least=50, most=60)
    status = {r["path"]: r["status"] for r in out["status"].collect()}
    assert status == {
        "google/red_clay/a.png": "kept", "google/red_clay/b.PNG": "resized", "bing/sand/c.png": "kept",
        "bing/sand/tiny.png": "discarded", "bing/sand/broken.jpg": "error", "root.png": "kept",
    }
    assert tuple(out["counts"].first()) == (6, 4, 1, 1, 1)
    shrunk = {r["name"]: r for r in out["pixels"].collect()}
    assert len(shrunk) == 4
    small = next(r for n, r in shrunk.items() if n.endswith("_b"))
    assert (small["width"], small["height"], len(small["data"])) == (80, 60, 80 * 60 * 3)
    near = P.from_bytes(small["data"], 60, 80, 3).astype(int) - gradient(80, 60).astype(int)
    assert np.abs(near[5:-5, 5:-5]).max() <= 4
    hashes = images.perceptual_hashes(decoded)
    values = {r["image"]: r["phash"] for r in hashes.collect()}
    broken = [v for k, v in values.items() if k.endswith("broken.jpg")]
    assert broken == [None]
    removed = dedup.find_duplicates(hashes, 6).collect()
    kinds = {(r["image"].split("_", 1)[-1], r["duplicate_of"].split("_", 1)[-1]) for r in removed}
    assert ("b.PNG", "a.png") in kinds
    assert not any("c.png" in pair for pair in kinds)


def test_every_image_gets_three_channels(spark):
    kind = "origin string, height int, width int, nChannels int, mode int, data binary"
    rng = np.random.default_rng(1)
    shapes = [(2, 3, 1), (2, 2, 3), (1, 4, 4), (1, 2, 2)]
    pixels = [rng.integers(0, 256, s).astype(np.uint8) for s in shapes]
    rows = [(f"p{i}", (f"file:{i}", p.shape[0], p.shape[1], p.shape[2], 0, p.tobytes())) for i, p in enumerate(pixels)]
    df = spark.createDataFrame([*rows, ("bad", None)], f"path string, pixels struct<{', '.join(f.replace(' ', ':') for f in kind.split(', '))}>")
    got = {r["path"]: r["pixels"] for r in images.to_rgb(df).collect()}
    assert got.pop("bad") is None and images.to_rgb(df).columns == df.columns
    for i, p in enumerate(pixels):
        found = got[f"p{i}"]
        want = np.repeat(p[:, :, :1], 3, axis=2) if p.shape[2] < 3 else p[:, :, :3]
        assert (found["nChannels"], found["mode"]) == (3, images.BGR_MODE)
        assert (P.from_bytes(found["data"], p.shape[0], p.shape[1], 3) == want).all()


def test_lanczos_keeps_flat_images():
    flat = np.full((50, 70, 3), 93, dtype=np.uint8)
    assert (P.resize(flat, 20, 31) == 93).all()
    assert P.resize(flat, 20, 31).shape == (31, 20, 3)


def test_resize_rounds_half_to_even(spark):
    df = spark.createDataFrame([(1001, 2048), (1025, 2050), (3000, 500)], "w int, h int")
    w, h, changed = resolution.target_dims(F.col("w"), F.col("h"), 1024)
    assert [tuple(r) for r in df.select(w, h, changed).collect()] == [
        (1001, 2048, False), (1024, round(2050 * (1024 / 1025)), True), (3000, 500, False)
    ]
    w, h, _ = resolution.target_dims(F.col("w"), F.col("h"), 1024, "longest_side")
    assert [tuple(r) for r in df.select(w, h).collect()][0] == (round(1001 * 0.5), 1024)


def test_logs_round_trip(spark, tmp_path):
    rows = [
        ("a", 0.31234, 0.1, 0.2, 0.1, False, True, "passed"),
        ("b", 0.1, 0.2, 0.2, 0.1, False, False, "low_score"),
        ("c", None, None, 0.5, 0.1, True, False, "overlay"),
        ("d", None, None, None, None, False, False, "load_error"),
    ]
    decisions = spark.createDataFrame(
        rows, "image string, positive double, negative double, overlay double, clean double, flagged boolean, kept boolean, reason string"
    )
    writers.write_decision_logs(decisions, str(tmp_path))
    log = readers.target_log(spark, f"{tmp_path}/target_filter.csv")
    flags = readers.overlay_log(spark, f"{tmp_path}/overlay_filter.csv")
    got = {r["image"]: r for r in scoring.merge_overlay_log(log, flags).collect()}
    assert (got["a"]["positive"], got["a"]["kept"], got["a"]["overlay"]) == (0.3123, True, 0.2)
    assert (got["c"]["positive"], got["c"]["reason"], got["c"]["flagged"]) == (None, "overlay", True)
    assert (got["d"]["reason"], got["d"]["overlay"]) == ("low_score", None)
    assert readers.target_log(spark, f"{tmp_path}/none.csv").count() == 0


def test_log_last_row_wins(spark, tmp_path):
    (tmp_path / "log.csv").write_text(
        "filename,positive_score,negative_score,kept\n a ,0.5,N/A,False\n,0.1,0.1,True\na,0.6,nan,True\n"
    )
    got = [tuple(r) for r in readers.target_log(spark, f"{tmp_path}/log.csv").collect()]
    assert got == [("a", 0.6, None, True, "passed")]


def test_label_file(spark, tmp_path):
    entries = [
        {"image": "a", "hue": "red", "scores": {"hue": {"assigned": "red", "confidence": 0.3, "runner_up": "tan", "runner_up_score": 0.1}}},
        {"image": "b", "hue": "tan"},
        {"image": " ", "hue": "tan"},
        {"image": "a", "hue": "black", "scores": {"hue": {"assigned": "black", "confidence": 0.5}}},
    ]
    (tmp_path / "labels.json").write_text(json.dumps(entries[:2], indent=1))
    basic = {r["image"]: r for r in readers.label_records(spark, str(tmp_path), ("hue", "grain"), multi_line=True).collect()}
    assert basic["a"]["predicted"] == {"hue": "red", "grain": "unknown"}
    assert basic["a"]["margins"]["hue"] == pytest.approx(0.2) and basic["b"]["margins"]["hue"] is None
    (tmp_path / "labels_full.json").write_text(json.dumps(entries))
    full = {r["image"]: r for r in readers.label_records(spark, str(tmp_path), ("hue",), multi_line=True).collect()}
    assert set(full) == {"a", "b"} and full["a"]["predicted"]["hue"] == "black"
    assert full["a"]["margins"]["hue"] is None


def test_groups_file(spark, tmp_path):
    (tmp_path / "groups.json").write_text('{\n "k": ["a", "b", " "],\n "m": ["c"]}')
    got = {tuple(r) for r in readers.duplicate_groups(spark, f"{tmp_path}/groups.json", one_object=True).collect()}
    assert got == {("a", "k"), ("b", "k"), ("c", "m")}
    assert readers.duplicate_groups(spark, f"{tmp_path}/none.json").count() == 0
    groups = spark.createDataFrame(
        [("k", 0, ["a", "b"]), ("k", 1, ["d"]), ("m", 0, ["c"])], "duplicate_of string, piece long, removed array<string>"
    )
    writers.write_groups(groups, f"{tmp_path}/lines")
    back = {tuple(r) for r in readers.duplicate_groups(spark, f"{tmp_path}/lines").collect()}
    assert back == {("a", "k"), ("b", "k"), ("d", "k"), ("c", "m")}


def test_prompt_tables(spark):
    rows = readers.label_prompts(spark, {"hue": {"red": ["a", "b"], "tan": "c"}}).collect()
    assert [(r["label"], r["label_ord"], r["prompt_ord"], r["text"]) for r in rows] == [
        ("red", 0, 0, "a"), ("red", 0, 1, "b"), ("tan", 1, 0, "c")
    ]
    assert readers.group_prompts(spark, {"positive": ["p"], "clean": ["q", "r"]}).count() == 3
    assert readers.search_queries(spark, ["x", "y"]).count() == 2


def test_encode_with_a_given_model(spark):
    def make():
        def predict(texts):
            return np.asarray([[len(t), 1.0] for t in texts], dtype=np.float32)

        return predict

    prompts = readers.group_prompts(spark, {"positive": ["abc", ""], "clean": ["ab"]})
    got = {r["text"]: r["embedding"] for r in images.encode(prompts, "text", make, 2).collect()}
    assert got["abc"] == pytest.approx([3 / 10**0.5, 1 / 10**0.5], abs=1e-6)
    assert got[""] == [0.0, 1.0]


def test_thresholds(spark, tmp_path):
    config = scoring.Thresholds(0.3, 0.07)
    none = spark.createDataFrame([], S.FILTER_RUNS)
    row = readers.effective_thresholds(none, config).first()
    assert (row["threshold"], row["source"]) == (0.3, "config")
    writers.append_filter_run(spark, f"{tmp_path}/runs", scoring.CONFIGURED, "dedup", "x")
    writers.append_filter_run(spark, f"{tmp_path}/runs", scoring.Thresholds(0.5, 0.1), "dedup", "x")
    runs = spark.read.schema(S.FILTER_RUNS).parquet(f"{tmp_path}/runs")
    assert runs.count() == 2
    assert readers.thresholds(readers.effective_thresholds(runs, config)) == scoring.Thresholds(0.5, 0.1)


def test_manifest(spark, tmp_path):
    path = str(tmp_path / "manifest")
    state = readers.manifest(spark, path)
    assert state.count() == 0
    items = spark.createDataFrame([("a", "p/a"), ("b", "p/b"), ("", "p/")], "image string, source_path string")
    dups = spark.createDataFrame([("b", "a")], "image string, duplicate_of string")
    state = manifest.upsert(state, "dedup", manifest.dedup_updates(items, dups))
    writers.save_manifest(state, path, "v1")
    state = readers.manifest(spark, path)
    first = spark.createDataFrame([("a", True, "passed", 0.5, 0.1), ("n", False, "low_score", 0.2, 0.3)], "image string, kept boolean, reason string, positive double, negative double")
    state = manifest.upsert(state, "filter", manifest.filter_updates(first))
    writers.save_manifest(state, path, "v2")
    again = spark.createDataFrame([("a", True, "resume_existing", None, None), ("n", False, "overlay", None, None)], first.schema)
    state = manifest.upsert(readers.manifest(spark, path), "filter", manifest.filter_updates(again))
    got = {r["image"]: r for r in state.collect()}
    assert set(got) == {"a", "b", "n"}
    assert got["b"]["dedup"]["duplicate_of"] == "a" and got["a"]["dedup"]["kept"] and got["n"]["dedup"] is None
    assert (got["a"]["filter"]["reason"], got["a"]["filter"]["positive_score"]) == ("resume_existing", 0.5)
    assert (got["n"]["filter"]["reason"], got["n"]["filter"]["positive_score"]) == ("overlay", None)
    assert got["b"]["filter"] is None and got["a"]["filter"]["updated_at"] is not None


def test_outputs(spark, tmp_path):
    records = spark.createDataFrame(
        [("a", {"hue": "red"}, {"hue": ("red", 0.5, {"red": 0.5}, None, None)})], S.RECORDS
    )
    vectors = spark.createDataFrame([("a", [1.0]), ("z", [0.5])], "image string, embedding array<float>")
    writers.write_labels(records, str(tmp_path), ("hue", "grain"))
    back = readers.label_records(spark, str(tmp_path), ("hue", "grain")).first()
    assert back["predicted"] == {"hue": "red", "grain": "unknown"}
    writers.write_embeddings(records, vectors, f"{tmp_path}/emb", "m", "w")
    stored = readers.embeddings(spark, f"{tmp_path}/emb")
    assert stored.count() == 1 and readers.embedding_origin(stored) == "m"
    empty = steps.export_step(records.where("false"), ("hue",))
    writers.write_export(empty["clean"], empty["full"], f"{tmp_path}/out")
    assert spark.read.option("header", True).csv(f"{tmp_path}/out/labels.csv").count() == 0
    full = steps.export_step(records, ("hue",), places=[vectors.select("image", F.lit("x/a").alias("path"))])
    assert [tuple(r) for r in full["clean"].collect()] == [("item_00001.jpg", "red")]
    assert full["files"].first()["path"] == "x/a"
    writers.write_survivors(vectors, f"{tmp_path}/kept")
    writers.write_survivors(vectors.where("image = 'a'"), f"{tmp_path}/kept")
    assert spark.read.parquet(f"{tmp_path}/kept").count() == 1
    writers.write_metrics({"m": spark.createDataFrame([("c", 0.123456)], "category string, accuracy double")}, str(tmp_path))
    assert readers.category_accuracy(spark, f"{tmp_path}/m").first()["accuracy"] == 0.1235


def test_run_and_manifest(spark, tmp_path):
    from spark_curate.catalog import inputs as I

    folder = "/root/testdata/sf0.001"
    hashed = I.items(spark, folder).join(I.hashes(spark, folder), "image")
    outcome = steps.run_all(hashed, I.group_prompts(spark, folder), I.label_prompts(spark, folder), I.DUP_BITS, I.THRESHOLDS)
    state = steps.record_run(spark, outcome, f"{tmp_path}/m").cache()
    assert state.count() == 500
    removed = state.where("not dedup.kept").count()
    assert removed == outcome["dedup"]["duplicates"].count() > 0
    assert state.where("filter.kept").count() == state.where("label.labeled").count()
    board = steps.dashboard(outcome, hashed, hashed)
    assert board["funnel"].count() == 4 and board["anomalies"].where("rule = 'retention'").count() >= 1


def test_last_row_wins_in_file_order(spark, tmp_path):
    """The later file is the larger one, which Spark reads first."""
    folder = tmp_path / "log.csv"
    folder.mkdir()
    head = "filename,positive_score,negative_score,kept\n"
    (folder / "part-0.csv").write_text(head + "x,0.1,0.2,False\n")
    filler = "".join(f"y{i},0.5,0.1,True\n" for i in range(20_000))
    (folder / "part-1.csv").write_text(head + filler + "x,0.9,0.2,True\n")
    got = {r["image"]: r["kept"] for r in readers.target_log(spark, str(folder)).where("image = 'x'").collect()}
    assert got == {"x": True}


def test_label_lines_are_all_read(spark, tmp_path):
    lines = [json.dumps({"image": f"i{k}", "hue": "red"}) for k in range(5)]
    (tmp_path / "labels.json").write_text("\n".join(lines))
    assert readers.label_records(spark, str(tmp_path), ("hue",)).count() == 5
