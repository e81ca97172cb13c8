"""The stages one after the other, each against a plain version of what it should keep."""

from __future__ import annotations

import re
from pathlib import Path

import sentencepiece
from conftest import SF
from llm.test_simhash import brute_components, plain_fingerprint

import corpus_pipeline
from lakestrata.llm.common import stored
from lakestrata.llm.decontaminate import Items, covered, tokens


def table(spark, name):
    return spark.read.parquet(f"{SF}/{name}.parquet")


def test_stages(spark):
    docs = table(spark, "documents")
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert len(names) == len(set(names)) == 5
    kept = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        columns = docs.columns
        docs = stored(stage(spark, docs, SF), "test-stage")
        assert docs.columns == columns
        kept[name] = {r["doc_id"]: r["text"] for r in docs.select("doc_id", "text").collect()}
    everything = {r["doc_id"]: r["text"] for r in table(spark, "documents").collect()}
    toxic = {r["doc_id"]: r["toxic"] for r in table(spark, "labels").collect()}

    first = kept[names[0]]
    assert first.items() <= everything.items()
    assert not [i for i in everything if toxic.get(i) == 0 and i not in first]

    normal = lambda t: re.sub(r"[\x20\x09-\x0D]+", " ", t or "")
    least = {}
    for i, t in first.items():
        least[normal(t)] = min(i, least.get(normal(t), i))
    second = kept[names[1]]
    assert set(second) == set(least.values())

    prints = {i: plain_fingerprint(t) for i, t in second.items()}
    roots = brute_components(sorted(set(prints.values())), lambda a, b: (a ^ b).bit_count() <= 3)
    best = {}
    for i, f in prints.items():
        best[roots[f]] = min(i, best.get(roots[f], i))
    third = kept[names[2]]
    assert set(third) == set(best.values())

    items = Items([(r["item_id"], r["text"]) for r in table(spark, "benchmark").collect()])
    fourth = kept[names[3]]
    assert set(fourth) == {i for i, t in third.items() if not list(covered(t or "", items, 0.6))}
    passages = [" ".join(tokens(r["text"])) for r in table(spark, "benchmark").collect()]
    assert not [i for i, t in fourth.items() if any(p in " ".join(tokens(t or "")) for p in passages)]

    library = sentencepiece.SentencePieceProcessor(model_proto=Path(corpus_pipeline.TOKENIZER).read_bytes())
    rows = corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()
    assert {r["doc_id"]: r["ids"] for r in rows} == {i: library.encode(t or "") for i, t in fourth.items()}
    whole = {r["doc_id"]: r["ids"] for r in corpus_pipeline.run(spark, SF).collect()}
    assert whole == {r["doc_id"]: r["ids"] for r in rows}
