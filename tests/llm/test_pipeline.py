import numpy as np
from llm.helpers import FOLDER
from llm.test_packing import check
from llm.test_simhash import plain_fingerprint, plain_roots
from tokenizers import Tokenizer

import corpus_pipeline as P
import public_tokenizers
from tallyhouse.llm import decontaminate, pii
from tallyhouse.llm.common import read


def test_stages_against_plain_versions(spark):
    docs = read(spark, FOLDER, "documents")
    texts = {r.doc_id: r.text for r in docs.collect()}
    out, tables = docs, []
    for _, stage in P.STAGES[:-1]:
        before = out.columns
        out = stage(spark, out, FOLDER).cache()
        assert out.columns == before == docs.columns
        tables.append({r.doc_id: r for r in out.collect()})
    calm, single, clean, blotted = tables
    toxic = {r.doc_id for r in read(spark, FOLDER, "labels").filter("toxic = 1").collect()}
    assert len(calm) > 0.85 * len(texts) and len(set(texts) - set(calm) - toxic) <= 2
    prints = {i: plain_fingerprint(texts[i]) for i in calm}
    roots, least = plain_roots(set(prints.values())), {}
    for i in sorted(calm, reverse=True):
        least[roots[prints[i]]] = i
    assert set(single) == set(least.values())
    items = read(spark, FOLDER, "benchmark")
    leaked = {r.doc_id for r in decontaminate.matches(docs, items).collect()}
    assert set(clean) == set(single) - leaked
    assert {i: r.text for i, r in blotted.items()} == {i: pii.blotted(texts[i] or "", pii.find(texts[i])) for i in clean}
    assert all(r.n_chars == len(r.text or "") for r in blotted.values())

    rows = P.run(spark, FOLDER).collect()
    check(rows)
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    for i, r in blotted.items():
        parts = sorted((p.piece, p.ids) for p in rows if p.doc_id == i)
        assert np.frombuffer(b"".join(bytes(x) for _, x in parts), "<u4").tolist() == [*t.encode(r.text or "", add_special_tokens=False).ids, 2]
    assert {r.doc_id for r in rows} == set(blotted)


def test_empty_documents(spark, folder):
    for name in ("documents", "labels", "benchmark"):
        read(spark, FOLDER, name).limit(0).write.parquet(f"{folder}/{name}.parquet")
    assert P.run(spark, folder).count() == 0
