from __future__ import annotations

import subprocess
import sys
from pathlib import Path

import __spark_entry__ as driver
import corpus_pipeline
from shoptrail.llm import lines as L
from shoptrail.llm import mixing
from tests.llm.fixtures import prose, spaced, text
from tests.llm.test_decontaminate import brute as leaks
from tests.llm.test_lines import brute as dropped
from tests.llm.test_neardup import brute as near

ROOT = Path(__file__).resolve().parents[2]


def tables(spark, folder):
    passage = " ".join(prose(77, 20))
    rows = [(k, text(k, 120)) for k in range(60)]
    rows += [(100 + k, " ".join(w + "%%%" for w in prose(k, 90))) for k in range(20)]
    rows += [(200 + k, text(5, 120)) for k in range(3)] + [(210, text(6, 120).replace(" ", " changed ", 1))]
    rows += [(220 + k, f"{text(400 + k, 80)}\nfollow page {k} of our great site") for k in range(12)]
    rows += [(240, f"{text(500, 60)} {passage} {text(501, 60)}"), (250, None), (251, ""), (252, "short")]
    docs = spark.createDataFrame([(i, t, "en", f"s{i % 3}", len(t or "")) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    docs.repartition(3).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(7, passage)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    labels = [(i, int(not 100 <= i < 120), 0) for i, _ in rows]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return rows, passage


def test_stages_equal_brute_force(spark, tmp_path):
    rows, passage = tables(spark, str(tmp_path))
    docs, seen = spark.read.parquet(f"{tmp_path}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, str(tmp_path))
        seen[name] = docs.collect()
        if name != "mix_sources":
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    good = {i: t for i, t in rows if len(spaced(t)) >= 50 and not 100 <= i < 120}
    assert {r.doc_id: r.text for r in seen["quality_rules"]} == good
    cut = {i: t for i, t, _, _ in dropped(list(good.items()), L.Options())}
    assert {r.doc_id: r.text for r in seen["line_dedup"]} == cut
    assert any("great site" in t for t in good.values()) and not any("great site" in t for t in cut.values())
    assert all(r.n_chars == len(r.text) for r in seen["line_dedup"])
    one = {r[0] for r in near(list(cut.items()), 5) if r[3]}
    assert {r.doc_id for r in seen["near_dedup"]} == one and not one & {200, 201, 202, 210}
    clean = {r[0] for r in leaks([(i, cut[i]) for i in one], [(7, passage)]) if not r[5]}
    assert {r.doc_id for r in seen["decontamination"]} == clean == one - {240}
    kept = spark.createDataFrame(seen["decontamination"], spark.read.parquet(f"{tmp_path}/documents.parquet").schema)
    copies = {r.doc_id: r.copies for r in mixing.plan_copies(kept).collect() if r.copies}
    got: dict[int, int] = {}
    for r in seen["mix_sources"]:
        got[r.doc_id] = got.get(r.doc_id, 0) + 1
    assert got == copies
    assert sorted(map(str, corpus_pipeline.run(spark, str(tmp_path)).collect())) == sorted(map(str, seen["mix_sources"]))


def test_all_are_registered():
    numbers = {int(n[2:].split("_")[0]) for n in driver.queries() if n.startswith("op")}
    assert numbers == set(range(1, 14)) and "pipeline" in driver.queries()


def test_entry_imports_without_the_operators(tmp_path):
    for name in ("catalog", "shoptrail"):
        target = tmp_path / name
        target.mkdir()
        for part in (ROOT / name).iterdir():
            if part.name not in ("llm", "__pycache__"):
                (target / part.name).symlink_to(part)
    (tmp_path / "__spark_entry__.py").write_text((ROOT / "__spark_entry__.py").read_text())
    run = subprocess.run([sys.executable, "-c", "import __spark_entry__ as e; print(len(e.queries()) == len(e.oracle_sql()) > 90)"], cwd=tmp_path, capture_output=True, text=True, env={"PATH": "/usr/bin:/bin"})
    assert run.stdout.strip() == "True", run.stderr
