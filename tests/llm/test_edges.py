"""Nulls, empty and very long texts, ties, repeated rows, empty tables and extra columns, for every operator."""

from __future__ import annotations

import gzip
import hashlib
import io
import math
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from test_llm_queries import check_pieces, check_secrets

from matchloom.llm import language, mixing, packing, secret_scan, set_join, sharding, stream_dedup, vector_index, warc
from matchloom.llm.common import components
from matchloom.llm.line_spread import clean_lines

LONG = " ".join(f"word{i} and{i % 7}" for i in range(40_000))


def clashing(df):
    """Extra columns named like those that operators make."""
    return df.withColumns({c: F.lit("x") for c in ("id", "n", "slot", "shard", "kept", "row", "site", "owner", "digest", "label", "h1", "vector", "tokens", "key", "batch", "node", "g", "check", "low", "__at", "__language", "__tokens", "__epoch", "__domain", "__id", "__gone")})


# --- exact copies


def exact_groups(rows):
    plain = lambda t: re.sub(r"[\x20\x09-\x0D]", "", t or "")
    groups = defaultdict(list)
    for r in rows:
        groups[plain(r[1])].append(r)
    out = []
    for key, members in groups.items():
        best = min(members, key=lambda r: (-len(r[1] or ""), r[0] is None, r[0] or 0))
        out += [(r[0], best[0], len(members), hashlib.sha256(key.encode()).hexdigest()) for r in members]
    return Counter(out)


EXACT = [(1, "a b"), (2, "ab"), (3, " a\tb\n"), (4, None), (5, ""), (6, " "), (7, LONG), (8, LONG), (None, "ab"), (9, "é"), (10, "é"), (2, "ab"), (11, " ab")]


def test_exact_copies(documents):
    rows = stream_dedup.exact_copies(clashing(documents(*EXACT))).collect()
    assert Counter((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in rows) == exact_groups(EXACT)
    assert sum(r.kept for r in rows) == len({r.text_sha256 for r in rows})
    assert all(r.kept <= (r.doc_id == r.keep_id) for r in rows)


def test_exact_copies_of_nothing(documents):
    assert stream_dedup.exact_copies(documents()).collect() == []


def test_exact_copies_confirm_bytes(spark, documents, monkeypatch):
    """With a digest that all texts share, full bytes keep different texts apart."""
    monkeypatch.setattr(stream_dedup, "digest", lambda text: F.unhex(F.lit("00")))
    rows = stream_dedup.exact_copies(documents((1, "a"), (2, "b"), (3, "b "), (4, "a"))).collect()
    assert {r.doc_id: (r.keep_id, r.group_size, r.kept) for r in rows} == {1: (1, 2, True), 4: (1, 2, False), 2: (3, 2, False), 3: (3, 2, True)}


# --- shards


def test_shards(spark):
    rows = spark.createDataFrame([(i % 50 if i % 9 else None, i % 3) for i in range(600)], "k long, v long")
    out = sharding.assign(rows, "k", [1.0, 2.0, 0.0, 1.0], [1.0, 2.0, 0.0, 1.0, 1.0]).collect()
    assert Counter((r.k, r.v) for r in out) == Counter((r.k, r.v) for r in rows.collect())
    slots = defaultdict(list)
    for r in out:
        slots[r.shard].append(r.slot)
        assert r.grown_shard in (r.shard, 4)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and 2 not in slots
    assert len({(r.k, r.shard) for r in out}) == len({r.k for r in out})


def test_shards_weights_and_growth(spark):
    rows = spark.range(20_000).select(F.col("id").alias("k"))
    out = sharding.assign(rows, "k", [1.0, 3.0], [1.0, 3.0, 1.0]).collect()
    share = sum(r.shard for r in out) / len(out)
    assert abs(share - 0.75) < 0.02 and abs(sum(r.grown_shard == 2 for r in out) / len(out) - 0.2) < 0.02
    assert sharding.assign(rows.limit(0), "k", [1.0]).collect() == []


# --- mixing


def fill(total, children):
    """(weight, capacity) of children -> shares, as real numbers, by filling up in rounds."""
    shares, open_ = {c: 0.0 for c in children}, {c for c, (w, cap) in children.items() if w and cap}
    total = min(total, sum(cap for w, cap in children.values() if w))
    while total > 1e-9 and open_:
        weights = sum(children[c][0] for c in open_)
        part = min(total, min((children[c][1] - shares[c]) / children[c][0] for c in open_) * weights)
        for c in open_:
            shares[c] += part * children[c][0] / weights
        total -= part
        open_ = {c for c in open_ if children[c][1] - shares[c] > 1e-9}
    return shares


def test_budgets_fill_siblings_first(spark):
    leaves = [("a", "x", 100), ("a", "y", 10), ("b", "x", 30), ("b", "z", 500), ("c", "x", 5)]
    table = spark.createDataFrame(leaves, "d string, l string, supply long")
    weights = {("a",): 5, ("b",): 3, ("a", "y"): 3, ("c",): 0}
    got = {(r.d, r.l): r.budget for r in mixing.budgets(table, ["d", "l"], weights, 50, 2).collect()}
    top = fill(322, {"a": (5, 220), "b": (3, 1060), "c": (0, 10)})
    want = {("a", k): v for k, v in fill(top["a"], {"x": (1, 200), "y": (3, 20)}).items()} | {("b", k): v for k, v in fill(top["b"], {"x": (1, 60), "z": (1, 1000)}).items()}
    assert got.pop(("c", "x")) == 0 and got.keys() == want.keys()
    assert all(abs(got[k] - want[k]) <= 2 for k in want) and sum(got.values()) == 322


def test_mix_rows(documents):
    docs = clashing(documents((1, "a b c", "en", "s1"), (2, None, "en", "s1"), (3, " ", None, None), (4, "d  e\tf g", None, None), (5, LONG, "en", "s2"), (1, "a b c", "en", "s1")))
    levels = {"lang": F.col("lang"), "source": F.col("source")}
    rows = mixing.mix(docs, levels, {}, 100, 3).collect()
    taken = Counter()
    for r in rows:
        taken[r["__lang"], r["__source"]] += r["__taken"]
        assert 0 < r["__taken"] <= r["__tokens"] and r["__epoch"] < 3
    assert taken["(none)", "(none)"] == 12 and taken["en", "s1"] == 18 and sum(taken.values()) == 80_010
    assert mixing.mix(documents(), levels, {}, 100, 3).collect() == []


def test_mix_cut_text(spark):
    row = spark.createDataFrame([(" a  b\tc d ", 2, 4), ("a b", 2, 2)], "t string, k long, n long")
    assert [r[0] for r in row.select(mixing.cut_text(F.col("t"), F.col("k"), F.col("n"))).collect()] == [" a  b", "a b"]


# --- lines


def test_lines(documents):
    rows = [(i, f"own {i}\n the end \n\nthe end", "en", f"s{i % 4}") for i in range(8)] + [(8, None), (9, ""), (10, "rare\nx", "en", "s1"), (11, "rare", "en", None), (10, "rare\nx", "en", "s1"), (None, "the end", "en", "s9")]
    out = {(r.doc_id, r.text, r.n_lines, r.n_removed) for r in clean_lines(clashing(documents(*rows)), 3).collect()}
    assert out == {(i, f"own {i}\n", 4, 2) for i in range(8)} | {(8, "", 1, 0), (9, "", 1, 0), (10, "rare\nx", 2, 0), (11, "rare", 1, 0), (None, "", 1, 1)}
    assert clean_lines(documents(), 3).collect() == []


def test_lines_near_and_far_from_the_threshold(documents):
    rows = [(100 * sites + s, f"line {sites}", "en", f"s{s}") for sites in (1, 19, 20, 21, 60) for s in range(sites)]
    gone = {r.doc_id // 100 for r in clean_lines(documents(*rows), 20).collect() if r.n_removed}
    assert gone == {20, 21, 60}


# --- WARC


PAGES = "page_id long, url string, html string, kept string"


def test_warc_round_trip(spark):
    big = "ü" * 600
    rows = [(1, "http://a/\r\nx", big, ""), (2, None, big, ""), (3, "u", None, ""), (4, "u", "", ""), (5, "u", "short", ""), (6, "u", "short", ""), (None, "u", big, ""), (7, "u", "WARC/1.1\r\n\r\n" * 300, ""), (2, None, big, "")]
    records = warc.resolve(spark.createDataFrame(rows, PAGES))
    archives = warc.normalise(warc.write_monolithic(records, archive_bytes=200))
    out = warc.read_records(archives).collect()
    assert len(out) == len(rows)
    by_id = defaultdict(list)
    for r in out:
        by_id[r.page_id].append(r)
    assert [r.record_type for r in by_id[2]] == ["response"] * 2
    assert by_id[1][0].refers_to == by_id[None][0].refers_to == 2 and by_id[1][0].record_type == "revisit"
    for page, _, html, _ in rows:
        r = by_id[page][0]
        payload = (html or "").encode()
        assert r.payload_bytes == len(payload) and r.payload_digest == hashlib.sha1(payload).hexdigest()
        if r.record_type == "response":
            assert bytes(r.payload) == payload
    for r in archives.collect():  # every index entry names a member of its own
        import json

        data = open(r.archive.removeprefix("file:"), "rb").read()
        entries = [json.loads(line) for line in open(r.archive.removeprefix("file:") + ".index")]
        assert sum(e["length"] for e in entries) == len(data) and len(entries) == r.records
        for e in entries:
            assert gzip.decompress(data[e["offset"] : e["offset"] + e["length"]]).startswith(b"WARC/1.1\r\n")


def test_warc_of_nothing(spark):
    archives = warc.normalise(warc.write_monolithic(warc.resolve(spark.createDataFrame([], PAGES))))
    assert warc.read_records(archives).collect() == []


def test_records_split_at_any_place():
    row = {"page_id": 1, "url": "u", "payload": b"x\r\n\r\ny" * 50, "payload_bytes": 300, "payload_digest": hashlib.sha1(b"x\r\n\r\ny" * 50).hexdigest(), "refers_to": None}
    data = warc.record(row) * 3
    for size in (1, 7, 1000):
        found = list(warc.split_records(iter([data[i : i + size] for i in range(0, len(data), size)])))
        assert [whole for _, whole in found] == [warc.record(row)] * 3
    assert b"".join(warc.inflated(io.BytesIO(gzip.compress(data[:50]) + gzip.compress(data[50:])))) == data
    with pytest.raises(ValueError):
        list(warc.split_records(iter([data[:-3]])))


# --- packing


def test_packing(spark, documents):
    import public_tokenizers

    rows = [(1, None), (2, ""), (3, LONG), (4, "don't. STOP"), (5, "don't. STOP"), (6, "\x00 <|endoftext|>"), (7, "a <|EndOfText|> b<|startoftext|>c. D"), (8, "<|endoftext|>"), (9, "last, one")]
    pieces = packing.pack(clashing(documents(*rows)), public_tokenizers.path("word_bpe_49k.json")).withColumn("ids_crc32", F.crc32("ids")).collect()
    check_pieces(pieces, dict(rows))
    assert packing.pack(documents(), public_tokenizers.path("word_bpe_49k.json")).collect() == []


def test_hilbert_steps_to_neighbours():
    for dimensions, bits in ((2, 3), (3, 2), (4, 2)):
        grid = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dimensions), -1).reshape(-1, dimensions)
        keys = packing.hilbert((grid + 0.5) / (1 << bits), bits)
        assert sorted(keys) == list(range(len(grid)))
        assert (np.abs(np.diff(grid[np.argsort(keys)], axis=0)).sum(axis=1) == 1).all()


# --- language


def test_gradients():
    """Backpropagation through time against differences."""
    rng = np.random.default_rng(0)
    network = language.Network.fresh(["a", "b", "c"], 3, 1)
    for name in ("inputs", "states"):
        setattr(network, name, [w.astype(np.float64) for w in getattr(network, name)])
    network.output, network.bias = network.output.astype(np.float64), network.bias.astype(np.float64)
    bytes_, lengths = language.padded([b"abca", b"ca", b"b"])
    labels = np.array([0, 2, 1])
    _, slopes = network.gradients(bytes_, lengths, labels)
    for weights, slope in zip(network.weights(), slopes):
        for at in [tuple(rng.integers(0, n) for n in weights.shape) for _ in range(12)] + [np.unravel_index(np.abs(slope).argmax(), slope.shape)]:
            kept, ends = weights[at], []
            for step in (1e-5, -1e-5):
                weights[at] = kept + step
                ends.append(network.gradients(bytes_, lengths, labels)[0])
            weights[at] = kept
            assert math.isclose((ends[0] - ends[1]) / 2e-5, slope[at], rel_tol=1e-4, abs_tol=1e-7)


def test_language_rows(spark, documents):
    german, english = "der hund und die katze schlafen nicht im haus", "the dog and the cat do not sleep in the house"
    rows = [(i, german if i % 2 else english, "de" if i % 2 else "en", "s") for i in range(60)] + [(100, None, None), (101, "", None), (102, "12 -- 3", "en"), (None, german, "de"), (103, LONG, None), (104, german, None)]
    docs = clashing(documents(*rows))
    predict = language.predictor(language.learn(docs))
    out = {r.doc_id: r for r in docs.select("doc_id", predict(F.col("text")).alias("p")).select("doc_id", "p.*").collect()}
    assert all(out[i].lang == "und" and out[i].score == 0 for i in (100, 101, 102))
    assert out[104].lang == out[None].lang == "de" and out[0].lang == "en" and out[103].lang in ("de", "en")
    assert language.learn(documents((1, "a", None))) is None
    assert documents((1, "a")).select(language.predictor(None)(F.col("text")).alias("p")).collect()[0].p.lang == "und"
    assert documents().select(predict(F.col("text"))).collect() == []


def test_words_read_once_or_each(spark):
    network = language.Network.fresh(["a", "b"], 4, 1)
    texts = ["été été x" + "y" * 60, "X-été", "", "1"]
    pooled = language.Reader(network).pool(pa.array(texts))
    for text, got in zip(texts, pooled):
        runs = [piece for run in re.findall(r"[^\W\d_]+", text.lower()) for piece in language.windows(run)]
        if not runs:
            assert (got == 0).all()
            continue
        bytes_, lengths = language.padded(runs)
        found, (mask, *_) = network.label(bytes_, lengths)
        assert np.allclose(got, (found * mask[:, :, None]).sum(axis=(0, 1)) / lengths.sum(), atol=1e-6)


# --- near copies


def near_components(rows, percent=75):
    sets = {}
    for id_, text in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        sets[id_] = {tuple(words[i : i + 5]) for i in range(len(words) - 4)} if len(words) >= 5 else {tuple(words)} if words else set()
    linked = lambda a, b: (both := len(sets[a] & sets[b])) and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both)
    links = [(a, b) for a in sets for b in sets if a < b and linked(a, b)]
    low, before = {i: i for i in sets}, None
    while low != before:
        before = dict(low)
        for a, b in links:
            low[a] = low[b] = min(low[a], low[b])
    return {i: (len(sets[i]), low[i]) for i in sets}


def varied(rng, words, share):
    return " ".join(f"z{rng.integers(1 << 30)}" if rng.random() < share else w for w in words)


def test_near_copies(documents):
    rng = np.random.default_rng(2)
    base = [[f"w{rng.integers(1 << 30)}" for _ in range(120)] for _ in range(4)]
    rows = [(1, None), (2, ""), (3, "one two"), (4, "ONE  two"), (5, "one"), (6, LONG), (7, LONG + " end"), (8, "a b c d e"), (9, "\ta B c d e\n")]
    rows += [(10 + i, varied(rng, base[i % 4], 0.015)) for i in range(60)]
    out = {r.doc_id: r for r in set_join.near_copies(clashing(documents(*rows)), small=8).collect()}
    want = near_components(rows)
    assert {i: (r.n_shingles, r.component_id) for i, r in out.items()} == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in out.values())
    assert set_join.near_copies(documents()).collect() == []
    odd = set_join.near_copies(documents((None, "a b c d e"), (3, "a b c d e"), (3, "a b c d e"))).collect()
    assert Counter((r.doc_id, r.component_id, r.kept) for r in odd) == Counter({(None, None, True): 1, (3, 3, True): 2})


def test_near_copies_in_deep_trees(documents):
    """Many texts that share most minwise tokens without being linked: the trees branch on and still find the links."""
    rng = np.random.default_rng(4)
    common = [f"c{i}" for i in range(60)]
    own = [[f"o{i}x{k}" for k in range(40)] for i in range(70)]
    rows = [(i, " ".join(common + own[i])) for i in range(70)] + [(100 + i, " ".join(common + own[i][:-2] + ["y", "z"])) for i in range(0, 70, 7)]
    for depth in (12, 1):  # with one level, what is left is compared in all pairs of blocks
        out = {r.doc_id: (r.n_shingles, r.component_id) for r in set_join.near_copies(documents(*rows), small=6, depth=depth).collect()}
        assert out == near_components(rows)


def test_trees_reach_the_recall():
    assert set_join.COORDINATES > set_join.trees_for(0.9999, 0.75) > set_join.trees_for(0.99, 0.75) >= 1


def test_root_of_one_more_than_a_block(spark, documents):
    """A root node that is cut into two blocks is branched on, or pairs across them would be compared nowhere in its tree."""
    rows = [(i, f"a b c d e{i}") for i in range(8)]
    docs = documents(*rows).select("doc_id", "text")
    lows = spark.createDataFrame([(i, [i * 128 + c for c in range(128)], bytes((i * 31 + c) % 256 for c in range(128))) for i in range(8)], "id long, low array<int>, check binary")
    frontier = lows.select("id", F.when(F.col("id") < 7, 1).otherwise(2).cast("long").alias("node"))
    join = set_join._Join(docs, lows, 5, 75, small=6)
    join.roots(frontier)
    assert sorted(r.id for r in join.large.collect()) == list(range(7))
    join = set_join._Join(docs, lows, 5, 75, small=7)
    join.roots(frontier)
    assert join.large.isEmpty()


def pair(rng, shared, own):
    """Two sets with that many hashes in common and of their own."""
    words = rng.integers(0, 1 << 63, shared + 2 * own, dtype=np.uint64) * np.uint64(2) + rng.integers(0, 2, shared + 2 * own).astype(np.uint64)
    return np.sort(words[: shared + own]), np.sort(words[own:])


def found_share(trees, depth, pairs, seed, shared=240, own=40):
    """Share of pairs that trees over the minima of one permutation find ``depth`` levels down, node by node."""
    rng = np.random.default_rng(seed)
    donors, found = set_join._donors(), 0
    for _ in range(pairs):
        low = set_join.minima(pair(rng, shared, own), donors)
        same = low[0] == low[1]

        def below(levels):
            picks = rng.integers(set_join.COORDINATES, size=2 if rng.random() < 1 / 3 else 1)
            return levels == 0 or any(same[p] and below(levels - 1) for p in picks)

        found += same.sum() >= set_join.least_agreement(0.75) and any(same[t] and below(depth - 1) for t in range(trees))
    return found / pairs


def test_minima():
    """Shares of equal minima are those of the sets, for sets smaller and larger than the number of ranges."""
    rng, donors = np.random.default_rng(0), set_join._donors()
    for shared, own in ((3, 1), (12, 4), (60, 20), (600, 200)):
        agree = []
        for _ in range(300):
            low = set_join.minima(pair(rng, shared, own), donors)
            agree.append((low[0] == low[1]).mean())
        # A small set's minima are few, so its shares spread; none is beyond the margin of comparisons.
        assert abs(np.mean(agree) - shared / (shared + 2 * own)) < 0.02
    some = [np.sort(rng.integers(0, 1 << 63, n, dtype=np.uint64)) for n in (0, 1, 5, 1000)]
    low = set_join.minima(some, donors)
    assert (low[0] == 0).all() and (low[1] == low[1, 0]).all()
    tokens = [set(((s >> np.uint64(16)) & np.uint64(0xFFFFFFFF)).tolist()) for s in some]
    assert all(set(row.tolist()) <= t for row, t in zip(low[1:], tokens[1:]))
    for s, row in zip(some[1:], low[1:]):  # the minimum of each range that isn't empty
        for r in range(set_join.COORDINATES):
            inside = s[(s >> np.uint64(57)) == r]
            assert not len(inside) or row[r] == int(inside.min() >> np.uint64(16)) & 0xFFFFFFFF
    alone = [set_join.minima([s], donors)[0] for s in some]
    assert (np.stack(alone) == low).all()


def test_recall_by_depth():
    """The computed recall is that of trees over shared minima, and the trees of near_copies reach the target at any depth."""
    for trees, depth in ((4, 3), (8, 8)):
        assert abs(found_share(trees, depth, 2000, 1) - set_join.recall_at(trees, 0.75, depth)) < 0.03
    for depth in (3, 5, 7, 9):
        trees = set_join.trees_for(0.9999, 0.75, depth)
        assert set_join.recall_at(trees, 0.75, depth) >= 0.9999
        assert found_share(trees, depth, 1500, 2) >= 0.998
        assert found_share(trees, depth, 500, 3, shared=30, own=5) >= 0.98
    last = set_join.deepest(0.9999, 0.75, 1000)
    assert last > 9 and set_join.recall_at(set_join.trees_for(0.9999, 0.75, last), 0.75, last) >= 0.9999 > set_join.recall_at(set_join.COORDINATES, 0.75, last + 1)


def test_deep_nodes_get_more_trees(documents, monkeypatch):
    """Documents that share half of their tokens: nodes of nine take several levels, and those documents get further trees."""
    rng = np.random.default_rng(8)
    common = [f"c{i}" for i in range(80)]
    rows = [(i, " ".join(common + [f"o{i}x{k}" for k in range(60)])) for i in range(160)]
    rows += [(1000 + i, " ".join(common + [f"o{i}x{k}" for k in range(59)] + ["z"])) for i in range(0, 160, 8)]
    calls = []
    grow = set_join._Join.grow
    monkeypatch.setattr(set_join._Join, "grow", lambda self, *a: calls.append(grow(self, *a)) or calls[-1])
    out = {r.doc_id: (r.n_shingles, r.component_id) for r in set_join.near_copies(documents(*rows), small=9).collect()}
    assert out == near_components(rows)
    assert len(calls) > 1 and calls[0][1] > 3 and all(c[1] > 1 for c in calls)


def test_components(spark):
    rng = np.random.default_rng(3)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 400, (300, 2))] + [(i, i + 1) for i in range(500, 560)] + [(7, 7)]
    low = {i: i for e in edges if e[0] != e[1] for i in e}
    for _ in range(100):
        for a, b in edges:
            if a != b:
                low[a] = low[b] = min(low[a], low[b])
    got = {r.id: r.component_id for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == low
    assert components(spark.createDataFrame([], "u long, v long")).collect() == []


# --- vectors


def test_vectors(spark):
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(12, 8))
    points = [(i, (centres[i % 12] + rng.normal(size=8) * 0.12).tolist()) for i in range(150)]
    points += [(200, points[3][1]), (201, points[3][1]), (202, [2 * x for x in points[3][1]]), (203, None), (204, []), (205, [0.0] * 8), (206, [1.0] * 7 + [float("nan")]), (207, [1.0] * 7 + [None]), (208, [1.0] * 7 + [float("inf")]), (209, [1.0, 2.0]), (None, points[5][1])]
    points += [(300, [1.0, 0.0, 0.0]), (301, [1.0, 0.001, 0.0]), (302, [0.0, 1.0, 0.0]), (303, [-5.0]), (304, [-1.0])]
    table = spark.createDataFrame([(i, v, "x") for i, v in points], "vec_id long, embedding array<double>, vector string")
    out = {r.vec_id: r for r in vector_index.near_vectors(table, words=4, block=16, recall=1.0).collect()}
    fine = {i: np.array(v) / np.linalg.norm(v) for i, v in points if i is not None and (i < 203 or i >= 300)}
    links = {i: {j for j in fine if j != i and len(fine[i]) == len(fine[j]) and fine[i] @ fine[j] >= 0.95} for i in fine}
    assert links[300] == {301} and links[303] == {304}
    low = {i: i for i in fine}
    for _ in fine:
        for i in fine:
            for j in links[i]:
                low[i] = low[j] = min(low[i], low[j])
    for i in fine:
        assert (out[i].n_links, out[i].component_id, out[i].kept) == (len(links[i]), low[i], low[i] == i)
    assert all((out[i].n_links, out[i].component_id, out[i].kept) == (0, i, True) for i in (203, 204, 205, 206, 207, 208, 209, None))
    assert vector_index.near_vectors(table.limit(0)).collect() == []


def test_vectors_beside_a_hot_group(spark):
    """A third of the rows in one tight group: the links of all others, near the threshold and across cells, are found too."""
    rng = np.random.default_rng(6)
    shift = lambda v, size: v + size * (d := rng.normal(size=v.shape)) / np.linalg.norm(d, axis=-1, keepdims=True)
    units = lambda v: v / np.linalg.norm(v, axis=-1, keepdims=True)
    hot = units(rng.normal(size=16)) + 1e-5 * rng.normal(size=(600, 16))
    base = units(rng.normal(size=(600, 16)))
    near = shift(base, 0.31)  # most at a cosine between 0.95 and 0.96
    points = np.concatenate([hot, base, near])
    table = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(points)], "vec_id long, embedding array<double>")
    out = {r.vec_id: r for r in vector_index.near_vectors(table, block=64).collect()}
    fine = units(points)
    hits = fine @ fine.T >= 0.95
    assert hits[600:1200, 1200:].diagonal().sum() > 200
    np.fill_diagonal(hits, False)
    low = np.arange(len(fine))
    for _ in range(100):
        low = np.minimum(low, np.where(hits, low[None], len(low)).min(axis=1))
    assert [(out[i].n_links, out[i].component_id, out[i].kept) for i in range(len(fine))] == [(int(n), int(c), c == i) for i, (n, c) in enumerate(zip(hits.sum(axis=1), low))]


def test_traversal_is_in_order():
    rng = np.random.default_rng(0)
    a, b = rng.random(6), rng.random(5)
    cells = list(vector_index.multi_sequence(a, b, 0.9))
    costs = [a[i] + b[j] for i, j in cells]
    assert costs == sorted(costs) and len(set(cells)) == len(cells) == sum(x + y <= 0.9 for x in a for y in b)


# --- secrets


def test_secret_rows(spark, documents):
    key = "a1B2" * 8
    rows = [(1, None, "en", "s1"), (2, "", "en", "s1"), (3, "password: token: abcdefgh", "en", "s1"), (4, f"é TOKEN = '{'0f' * 20}' AKIA{'Z' * 16}", "en", "s1")]
    rows += [(10 + i, f"x {key} y api_key=EXAMPLEKEY1 \x01 secret:short", "en", f"s{i}") for i in range(6)] + [(20, "only q9Z" * 4 + "q9Z" * 9, "en", None), (21, LONG + " passwd=hunter22", None, None), (22, "abc" + "0" * 23 + "\n" + "f" * 24, "en", "s2"), (23, "token\x01: abcdefgh token\x02= abcdefgh secret\x01\x02:longvalue \x01password=abcdef\x01gh", "en", "s2")]
    rows += [(20, "only q9Z" * 4 + "q9Z" * 9, "en", None)]
    from matchloom.llm.queries import secret_columns

    found = secret_scan.find_secrets(clashing(documents(*rows)).drop("owner"), F.col("source"), F.concat_ws("/", "source", "lang"))
    out = found.select(*secret_columns()).collect()
    docs = {r[0]: type("Doc", (), {"text": r[1], "source": r[3] if len(r) > 3 else None}) for r in rows}
    once = {r.doc_id: r for r in out}
    check_secrets(list(once.values()), docs)
    assert len(out) == len(rows) and once[20].spans.startswith("owned:") and "owned" not in once[10].spans
    assert secret_scan.find_secrets(documents(), F.col("source"), F.col("lang")).collect() == []
