"""Registered queries: against DuckDB where they have a statement, else against plain versions."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import defaultdict

import pytest
from compare import difference

from matchloom.llm import queries


@pytest.mark.parametrize("name", sorted(queries.CHECKS))
def test_matches_duckdb(spark, sf_dir, duck, name):
    assert difference(queries.QUERIES[name](spark, sf_dir), duck, queries.CHECKS[name]) is None


def check_pieces(pieces, texts, repeated=False):
    """An exact round trip: the pieces of all sequences hold every token once."""
    import public_tokenizers
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    sequences, of_document = defaultdict(list), defaultdict(list)
    for p in pieces:
        sequences[p.sequence_id].append((p.offset, p.length))
        of_document[p.doc_id].append(p)
    padding = tokens = 0
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at and length > 0
            at += length
        assert at <= 2048
        padding += 0 if at & (at - 1) == 0 else 2048 - at
        tokens += at
    assert padding <= 0.02 * tokens
    assert of_document.keys() == texts.keys()
    for doc_id, text in texts.items():
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [1]
        at = 0
        for p in sorted(of_document[doc_id], key=lambda p: p.start):
            assert p.start == at and p.doc_tokens == len(ids)
            assert p.ids_crc32 == zlib.crc32(b"".join(i.to_bytes(4, "little") for i in ids[at : at + p.length]))
            at += p.length
        assert at == len(ids)


def test_packing_round_trip(spark, sf_dir):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    check_pieces(queries.QUERIES["op1_hilbert_packing"](spark, sf_dir).collect(), texts)


def test_language_on_held_out_rows(spark, sf_dir):
    rows = queries.QUERIES["op3_byte_language"](spark, sf_dir).collect()
    truth = {r.doc_id: r for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    assert sorted(r.doc_id for r in rows) == sorted(truth)
    held = [r for r in rows if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 for r in rows)
    assert sum(r.lang_pred == truth[r.doc_id].lang for r in held) >= 0.95 * len(held)


KINDS = {
    "assign": (re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A), 2, 6),
    "access": (re.compile("AKIA[A-Z0-9]+"), 0, 20),
    "hex": (re.compile("[0-9a-f]+"), 0, 24),
}


def base_spans(text):
    found = []
    for rank, (kind, (pattern, group, least)) in enumerate(KINDS.items()):
        found += [(m.start(), rank, kind, m.end(), m[group]) for m in pattern.finditer(text or "") if len(m[group]) >= least]
    return sorted(found)


def check_secrets(rows, docs):
    """Base spans by Python's patterns; owners of each value counted over all documents."""
    owners = defaultdict(set)
    for d in docs.values():
        for *_, value in base_spans(d.text):
            owners[value].add(d.source)
    assert sorted(r.doc_id for r in rows) == sorted(docs)
    for r in rows:
        base = base_spans(docs[r.doc_id].text)
        told = [f"{kind}:{start}:{end}" for start, _, kind, end, _ in base]
        assert r.base_sha256 == hashlib.sha256(",".join(told).encode()).hexdigest()
        assert [x for x in r.spans.split(",") if x and not x.startswith("owned")] == told
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(b[2] == k for b in base) for k in KINDS)
        live = sum(len(owners[b[4]]) <= 2 for b in base)
        assert r.n_live - r.spans.count("owned:") == live
        assert r.n_example == sum(len(owners[b[4]]) >= 5 for b in base)
        for span in (x for x in r.spans.split(",") if x.startswith("owned")):
            token = docs[r.doc_id].text[slice(*map(int, span.split(":")[1:]))]
            assert len(token) >= 20 and all(re.search(p, token) for p in ("[0-9]", "[a-z]", "[A-Z]"))


def test_secrets(spark, sf_dir):
    docs = {r.doc_id: r for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    check_secrets(queries.QUERIES["op10_secret_owners"](spark, sf_dir).collect(), docs)
