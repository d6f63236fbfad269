"""Language of texts by a bidirectional gated recurrent network over bytes.

The network reads runs of letters, lower-cased, as UTF-8 bytes (long runs in windows of ``WINDOW`` bytes), once in each
direction, and labels every position with probabilities of the learned languages. A document's probabilities are the
mean over all its positions. It is trained in numpy by backpropagation through time, on the driver, on a bounded sample:
``documents`` labelled rows of each language in the order of a hash of their ids, and at most ``runs`` letter runs of
each, taken evenly from the whole text.

A label depends on its run alone, so each distinct run of a batch is read once, however often it occurs.

Defined results. A text that is null or has no letter is ``und`` with score 0. Rows without label or id teach nothing.
Without any labelled row all texts are ``und``. Repeated rows get the same result. Extra columns stay.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from matchloom.llm.common import batch_settings, give_back, hold
from matchloom.storage import materialize

WINDOW = 24
UNKNOWN = "und"
# Runs whose result a worker remembers; a bound on its memory that doesn't change results.
REMEMBERED = 100_000


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


@dataclass
class Network:
    """Weights of both directions: input (256 x 3h: update, reset, candidate), state (h x 3h); output (2h x languages)."""

    languages: list[str]
    inputs: list[np.ndarray]
    states: list[np.ndarray]
    output: np.ndarray
    bias: np.ndarray

    @classmethod
    def fresh(cls, languages: list[str], hidden: int, seed: int) -> Network:
        rng = np.random.default_rng(seed)
        draw = lambda *shape: rng.normal(0, 1 / np.sqrt(hidden), shape).astype(np.float32)
        return cls(languages, [draw(256, 3 * hidden) for _ in range(2)], [draw(hidden, 3 * hidden) for _ in range(2)], draw(2 * hidden, len(languages)), np.zeros(len(languages), np.float32))

    def weights(self) -> list[np.ndarray]:
        return [*self.inputs, *self.states, self.output, self.bias]

    def _read(self, way: int, bytes_: np.ndarray, mask: np.ndarray) -> tuple[np.ndarray, list[tuple]]:
        """States after each position (time x rows x h), and what going back needs."""
        inputs, state = self.inputs[way], self.states[way]
        h = state.shape[0]
        held, now, trace = np.zeros((bytes_.shape[1], len(bytes_), h), state.dtype), np.zeros((len(bytes_), h), state.dtype), []
        for t in range(bytes_.shape[1]):
            given = inputs[bytes_[:, t]]
            gates = _sigmoid(given[:, : 2 * h] + now @ state[:, : 2 * h])
            update, reset = gates[:, :h], gates[:, h:]
            scaled = reset * now
            candidate = np.tanh(given[:, 2 * h :] + scaled @ state[:, 2 * h :])
            on = mask[:, t, None]
            step = update * on
            trace.append((now, update, reset, candidate, scaled, on))
            now = now + step * (candidate - now)
            held[t] = now
        return held, trace

    def _back(self, way: int, bytes_: np.ndarray, trace: list[tuple], errors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Gradients of input and state weights from those of the states, going back through time."""
        inputs, state = self.inputs[way], self.states[way]
        h = state.shape[0]
        d_inputs, d_state, carry = np.zeros_like(inputs), np.zeros_like(state), np.zeros_like(errors[0])
        for t in range(len(trace) - 1, -1, -1):
            before, update, reset, candidate, scaled, on = trace[t]
            carry = carry + errors[t]
            d_update = carry * (candidate - before) * on * update * (1 - update)
            d_candidate = carry * update * on * (1 - candidate**2)
            d_scaled = d_candidate @ state[:, 2 * h :].T
            d_reset = d_scaled * before * reset * (1 - reset)
            d_given = np.concatenate([d_update, d_reset, d_candidate], axis=1)
            np.add.at(d_inputs, bytes_[:, t], d_given)
            d_state[:, : 2 * h] += before.T @ d_given[:, : 2 * h]
            d_state[:, 2 * h :] += scaled.T @ d_candidate
            carry = carry * (1 - update * on) + d_scaled * reset + d_given[:, : 2 * h] @ state[:, : 2 * h].T
        return d_inputs, d_state

    def label(self, bytes_: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, tuple]:
        """Probabilities of every position (rows x time x languages), and what going back needs."""
        rows, time = bytes_.shape
        mask = (np.arange(time) < lengths[:, None]).astype(self.output.dtype)
        # The other direction reads each run from its last byte.
        turned = np.where(mask > 0, lengths[:, None] - 1 - np.arange(time), np.arange(time))
        ahead, trace_a = self._read(0, bytes_, mask)
        backwards = np.take_along_axis(bytes_, turned, 1)
        behind, trace_b = self._read(1, backwards, mask)
        behind_here = np.take_along_axis(behind.transpose(1, 0, 2), turned[:, :, None], 1)
        both = np.concatenate([ahead.transpose(1, 0, 2), behind_here], axis=2)
        scores = both @ self.output + self.bias
        scores = np.exp(scores - scores.max(axis=2, keepdims=True))
        return scores / scores.sum(axis=2, keepdims=True), (mask, turned, trace_a, trace_b, backwards, both)

    def gradients(self, bytes_: np.ndarray, lengths: np.ndarray, labels: np.ndarray) -> tuple[float, list[np.ndarray]]:
        """Mean cross entropy over all positions, and its gradients in the order of ``weights``."""
        found, (mask, turned, trace_a, trace_b, backwards, both) = self.label(bytes_, lengths)
        total, h = mask.sum(), self.states[0].shape[0]
        right = np.take_along_axis(found, labels[:, None, None], 2)[:, :, 0]
        loss = float(-(np.log(np.maximum(right, 1e-12)) * mask).sum() / total)
        errors = found.copy()
        np.put_along_axis(errors, np.broadcast_to(labels[:, None, None], (*found.shape[:2], 1)), right[:, :, None] - 1, 2)
        errors *= mask[:, :, None] / total
        d_output = both.reshape(-1, 2 * h).T @ errors.reshape(-1, errors.shape[2])
        d_both = errors @ self.output.T
        d_behind = np.take_along_axis(d_both[:, :, h:], turned[:, :, None], 1)
        a = self._back(0, bytes_, trace_a, d_both[:, :, :h].transpose(1, 0, 2))
        b = self._back(1, backwards, trace_b, d_behind.transpose(1, 0, 2))
        return loss, [a[0], b[0], a[1], b[1], d_output, errors.sum(axis=(0, 1))]


def padded(runs: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    lengths = np.array([len(r) for r in runs], np.int64)
    time = int(lengths.max())
    return np.frombuffer(b"".join(r.ljust(time, b"\0") for r in runs), np.uint8).reshape(len(runs), time), lengths


def train(runs: list[bytes], labels: list[str], hidden: int = 12, steps: int = 700, rows: int = 384, rate: float = 0.01, seed: int = 3) -> Network:
    """Adam over batches of runs of like length; each language is drawn equally often."""
    languages = sorted(set(labels))
    network = Network.fresh(languages, hidden, seed)
    rng = np.random.default_rng(seed)
    code = np.array([languages.index(x) for x in labels])
    by_length = np.argsort([len(r) for r in runs], kind="stable")
    weight = 1 / np.bincount(code)[code[by_length]]
    mean, square = ([np.zeros_like(w) for w in network.weights()] for _ in range(2))
    for step in range(1, steps + 1):
        # A third of the runs, of neighbouring lengths, from a random place on.
        low = rng.integers(0, max(1, len(runs) - len(runs) // 3))
        near = slice(low, low + max(1, len(runs) // 3) + 1)
        chosen = by_length[near][rng.choice(len(by_length[near]), rows, p=weight[near] / weight[near].sum())]
        bytes_, lengths = padded([runs[i] for i in chosen])
        _, slopes = network.gradients(bytes_, lengths, code[chosen])
        pace = rate * min(1.0, 2 * (1 - step / (steps + 1)))
        for w, g, m, s in zip(network.weights(), slopes, mean, square):
            m += 0.1 * (g - m)
            s += 0.01 * (g * g - s)
            w -= (pace * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.99**step)) + 1e-8)).astype(w.dtype)
    return network


def letter_runs(texts: pa.Array) -> pa.ListArray:
    """The runs of letters of each text, lower-cased; with empty ones between."""
    return pc.split_pattern(pc.replace_substring_regex(pc.utf8_lower(pc.fill_null(texts, "")), r"[^\pL]+", " "), " ")


def windows(run: str) -> list[bytes]:
    data = run.encode()
    return [data[at : at + WINDOW] for at in range(0, len(data), WINDOW)]


class Reader:
    """Sums of a run's position probabilities, remembered by run."""

    def __init__(self, network: Network) -> None:
        self.network, self.place = network, {"": 0}
        self.sums = np.zeros((1, len(network.languages) + 1))

    def places(self, runs: list[str]) -> np.ndarray:
        new = [r for r in runs if r not in self.place]
        if len(self.place) + len(new) > REMEMBERED and len(self.place) > 1:
            self.place, self.sums = {"": 0}, self.sums[:1]
            new = [r for r in runs if r]
        if new:
            self.sums = np.concatenate([self.sums, self._read(new)])
            self.place.update(zip(new, range(len(self.place), len(self.place) + len(new))))
        return np.fromiter(map(self.place.__getitem__, runs), np.int64, len(runs))

    def _read(self, runs: list[str]) -> np.ndarray:
        pieces, owner = [], []
        for i, run in enumerate(runs):
            cut = windows(run)
            pieces += cut
            owner += [i] * len(cut)
        owner_of = np.array(owner)
        out = np.zeros((len(runs), len(self.network.languages) + 1))
        order = np.argsort([len(p) for p in pieces], kind="stable")
        for at in range(0, len(order), 1024):
            part = order[at : at + 1024]
            bytes_, lengths = padded([pieces[i] for i in part])
            found, (mask, *_) = self.network.label(bytes_, lengths)
            sums = (found * mask[:, :, None]).sum(axis=1)
            np.add.at(out, owner_of[part], np.concatenate([sums, lengths[:, None]], axis=1))
        return out

    def pool(self, texts: pa.Array) -> np.ndarray:
        """Mean probabilities of each text's positions; zeros if it has no letter."""
        runs = letter_runs(texts)
        flat = pc.dictionary_encode(runs.flatten())
        place = self.places(flat.dictionary.to_pylist())[flat.indices.to_numpy(zero_copy_only=False)]
        counts = pc.list_value_length(runs).to_numpy(zero_copy_only=False).astype(np.int64)
        text_of = np.repeat(np.arange(len(counts)), counts)
        width = self.sums.shape[1]
        out = np.stack([np.bincount(text_of, self.sums[place, c], len(counts)) for c in range(width)], axis=1)
        return out[:, :-1] / np.maximum(out[:, -1:], 1)


_READERS: dict[bytes, Reader] = {}


def predictor(network: Network | None):
    """Column function text -> struct<lang: string, score: double>."""
    if network is None:
        return lambda text: F.struct(F.lit(UNKNOWN).alias("lang"), F.lit(0.0).alias("score"))
    mark = network.output.tobytes()

    @F.arrow_udf("struct<lang: string, score: double>")
    def read(texts: pa.Array) -> pa.Array:
        hold("language", _READERS.clear)
        if mark not in _READERS:  # a worker keeps the reader of the last network
            _READERS.clear()
            _READERS[mark] = Reader(network)
        texts = texts.combine_chunks() if isinstance(texts, pa.ChunkedArray) else texts
        pooled = _READERS[mark].pool(texts)
        best, score = pooled.argmax(axis=1), pooled.max(axis=1)
        names = [network.languages[b] if s > 0 else UNKNOWN for b, s in zip(best, score)]
        give_back()
        return pa.StructArray.from_arrays([pa.array(names, pa.string()), pa.array(np.minimum(score, 1.0))], ["lang", "score"])

    return read


def held_out(id_: Column) -> Column:
    """Rows that nothing is learned from: CRC-32 of the id as text leaves 2 when divided by 4."""
    return F.coalesce(F.crc32(id_.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def _some_runs(most: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, runs = [], []
            for lang, found in zip(batch.column("lang").to_pylist(), letter_runs(batch.column("text")).to_pylist()):
                found = [r for r in found if r]
                picked = [found[i * len(found) // most] for i in range(most)] if len(found) > most else found
                runs += picked
                langs += [lang] * len(picked)
            yield pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array(runs, pa.string())], ["lang", "run"])

    return run


def learn(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", lang_column: str = "lang", documents: int = 400, runs: int = 60) -> Network | None:
    """The network trained on a sample of the labelled rows that aren't held out."""
    spark = docs.sparkSession
    batch_settings(spark)
    rows = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"), F.col(lang_column).alias("lang"))
    rows = rows.where(F.col("lang").isNotNull() & F.col("id").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("id")))
    order = Window.partitionBy("lang").orderBy(F.xxhash64("id"), "id")
    ids = rows.select("id", "lang").withColumn("n", F.row_number().over(order)).where(F.col("n") <= documents).select("id").distinct()
    sample = rows.join(materialize(ids, "sample"), "id", "left_semi").select("lang", "text")
    found = sample.mapInArrow(_some_runs(runs), "lang string, run string").collect()
    found = sorted((r["run"], r["lang"]) for r in found)
    pieces = [(piece, lang) for run, lang in found for piece in windows(run)]
    return train([p for p, _ in pieces], [lang for _, lang in pieces]) if pieces else None
