import random

import numpy as np
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from tierflow.llm import packing, secret_scan
from tierflow.llm.decontamination import terms
from tierflow.llm.queries import tokenizer_path

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Clean documents, and one of each kind that a stage has to see."""
    rng = random.Random(4)
    words = [f"{a}{b}" for a in ("stone", "water", "reth", "ander", "house", "lyra") for b in range(40)]
    def prose(n):
        return " ".join(rng.choice(words) for _ in range(n))
    toxic = [prose(30) + f" {rng.choice(['idiot', 'moron', 'scum'])} " + prose(10) for _ in range(150)]
    clean = [prose(60) for _ in range(300)]
    item = prose(30) + ". " + prose(8) + "."
    base = prose(200).split()
    near = base[:100] + ["other"] + base[101:]
    extra = {"exact": clean[0], "near": " ".join(near), "base": " ".join(base), "leak": prose(40) + " " + item + " " + prose(40),
             "secret": prose(20) + ' token = "0123456789abcdef0123456789abcdef" ' + prose(20), "new toxic": prose(30) + " m0r0n " + prose(3),
             "empty": "", "null": None}
    texts = toxic + clean + list(extra.values())
    ids = {name: len(toxic) + len(clean) + k for k, name in enumerate(extra)}
    rows = [(k, t, "en", "src", len(t) if t is not None else None) for k, t in enumerate(texts)]
    path = str(tmp_path_factory.mktemp("pipeline"))
    spark.createDataFrame(rows, DOCS).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(k, 1, int(k < len(toxic))) for k in range(len(toxic) + len(clean))],
                          "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path, texts, ids, len(toxic)


def test_each_stage_takes_effect(spark, folder):
    path, texts, ids, toxic = folder
    docs, kept = spark.read.parquet(f"{path}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = docs.schema
        docs = corpus_pipeline.written(stage(spark, docs, path), name)
        assert docs.dtypes == spark.read.parquet(f"{path}/documents.parquet").dtypes, before
        kept[name] = {r.doc_id: r for r in docs.collect()}
    everything = set(range(len(texts)))
    gone = set(range(toxic)) | {ids["new toxic"]}
    assert set(kept["toxicity"]) == everything - gone
    # the exact copy of the first clean text and the later of the near pair go
    gone |= {ids["exact"], max(ids["base"], ids["near"])}
    assert set(kept["near_copies"]) == everything - gone
    gone |= {ids["leak"]}
    assert set(kept["decontamination"]) == everything - gone
    assert set(kept["secrets"]) == everything - gone
    for k, r in kept["secrets"].items():
        if k == ids["secret"]:
            assert "[secret]" in r.text and "0123456789abcdef" not in r.text and r.n_chars == len(r.text)
        else:
            assert r.text == texts[k]


def test_run_packs_what_is_left(spark, folder):
    path, texts, ids, toxic = folder
    out = corpus_pipeline.run(spark, path).toPandas()
    gone = set(range(toxic)) | {ids["new toxic"], ids["exact"], max(ids["base"], ids["near"]), ids["leak"]}
    assert set(out.doc_id) == set(range(len(texts))) - gone
    encoder = packing.Encoder.of(tokenizer_path())
    for k, pieces in out.groupby("doc_id"):
        if k != ids["secret"]:
            assert pieces.length.sum() == len(encoder.ids(texts[k] or "")) // 4 + 1
    for _, inside in out.sort_values("offset").groupby("sequence_id"):
        assert inside.offset.tolist() == np.cumsum([0, *inside.length])[:-1].tolist() and inside.length.sum() <= 1024


def test_registered():
    assert entry.queries()["pipeline"] is corpus_pipeline.run
    assert {q.split("_")[0] for q in entry.queries() if q.startswith("op")} >= {f"op{n}" for n in range(1, 11)}
    assert secret_scan.KINDS[:3] == ("assign", "access", "hex") and terms("A b") == ["a", "b"]
