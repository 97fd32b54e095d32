import random
import re
from collections import Counter

import corpus_pipeline
import pytest
from tests.llm.helpers import awkward, documents, prose
from tests.llm.test_simhash import components, plain_fingerprint

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture()
def folder(spark, scratch):
    """A folder of tables: toxic, copied and contaminated documents among clean ones."""
    rng = random.Random(26)
    items = [(k, prose(rng, 40)) for k in range(5)]
    rows, labels = [], []
    for k in range(500):
        text = ". ".join(prose(rng, rng.randrange(5, 15)) for _ in range(rng.randrange(2, 8)))
        toxic = k % 5 == 0
        rows.append((k, f"{text}. grimbol {prose(rng, 3)}" if toxic else text, f"s{k % 4}"))
        labels.append((k, 1, int(toxic)))
    clean = [r for r in rows if r[0] % 5]
    rows += [(1000 + k, clean[k][1].upper() if k % 2 else clean[k][1], "hot") for k in range(20)]
    rows += [(2000 + k, f"{prose(rng, 9)} {items[k][1]} {prose(rng, 9)}", "hot") for k in range(5)]
    rows += [(None if r[0] is None else 3000 + r[0], *r[1:]) for r in awkward(rng)]
    documents(spark, rows, clashing=True).write.parquet(f"{scratch}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{scratch}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{scratch}/benchmark.parquet")
    return scratch, rows


def test_every_stage_does_its_work_on_what_is_left(spark, folder):
    sf_dir, rows = folder
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    left = {}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, sf_dir)
        if name != "sharding":
            assert out.columns == docs.columns
            out.write.parquet(f"{sf_dir}/out{k}")
            docs = spark.read.parquet(f"{sf_dir}/out{k}")
            left[name] = docs.collect()
        else:
            left[name] = out.collect()
    after = {name: Counter(r.doc_id for r in got) for name, got in left.items()}
    # Toxic documents go, all others stay.
    toxic = {r[0] for r in rows if "grimbol" in (r[1] or "")}
    assert after["toxicity"] == Counter(r[0] for r in rows if r[0] not in toxic)
    # One row stays of each component of what came in.
    came = sorted(left["toxicity"], key=lambda r: (r.doc_id is None, r.doc_id or 0))
    groups = components([plain_fingerprint(r.text) for r in came])
    assert after["simhash"] == Counter(came[g].doc_id for g in set(groups))
    # Documents with a passage of the benchmark go, all others stay.
    assert after["decontamination"] == after["simhash"] - Counter(range(2000, 2005))
    assert not after["decontamination"] & Counter(range(2000, 2005))
    # The mix repeats or leaves out whole documents; its words are near 150 %.
    size = {r.doc_id: len(WORDS.findall(r.text or "")) for r in left["decontamination"]}
    assert set(after["mixing"]) <= set(size) and max(after["mixing"].values()) <= 2
    total = sum(size[d] * n for d, n in after["mixing"].items())
    slack = max(size.values()) / 2 + 0.02 * sum(size.values())  # whole texts: half the largest may be missing
    assert abs(total - 1.5 * sum(size.values())) <= slack
    # Every row of the mix has a place, and run() gives the same rows.
    assert after["sharding"] == after["mixing"]
    again = corpus_pipeline.run(spark, sf_dir).collect()
    assert sorted(map(tuple, again), key=repr) == sorted(map(tuple, left["sharding"]), key=repr)


def test_empty_documents(spark, folder):
    sf_dir, _ = folder
    docs = documents(spark, [])
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, sf_dir).collect() == []


def test_a_long_clean_document_stays(spark, folder):
    sf_dir, _ = folder
    rng = random.Random(27)
    long = "\n".join(prose(rng, 4).capitalize() + "." for _ in range(20_000))
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars")
    docs = docs.union(documents(spark, [(9001, long, "s"), (9002, f"{long}\nSuch a grimbol.", "s")]))
    kept = dict(corpus_pipeline.STAGES)["toxicity"](spark, docs, sf_dir).filter("doc_id > 9000").collect()
    assert [(r.doc_id, r.text) for r in kept] == [(9001, long)]
