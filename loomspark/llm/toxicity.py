"""Toxicity: a convolutional text classifier over hashed word embeddings, trained in numpy.

A word's vector is the sum of the vectors of its hashed parts: the word and its first characters, so that inflected forms
share what they begin with. Filters of several widths slide over the words; each filter's largest value over the whole
text goes to a logistic layer. A filter of width w is a sum of w projections of single words, so a word is projected once
and a text costs look-ups and additions.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property
from itertools import chain
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import id_type, map_batches, slices, whole_text, written

WIDTHS = (1, 2, 3)
#: Lengths of a word's first characters that have vectors of their own, besides the whole word.
STEMS = (3, 4, 5, 6)
_MARKS = ".,;:!?\"'()[]{}<>|*#$%&…«»“”‘’¿¡-"
KEPT_WORDS = 150_000


#: Checksums go on from those of what stands before the characters: "3:", "4:", ...
_BEFORE = [(n, crc32(f"{n}:".encode())) for n in STEMS]


def parts_of(word: str, buckets: int) -> list[int]:
    """The buckets of a word's parts; a part that a short word doesn't have is the whole word again."""
    word = word.strip(_MARKS)
    data = word.encode()
    if len(data) == len(word):
        return [crc32(data) % buckets, *[crc32(data[:n], before) % buckets for n, before in _BEFORE]]
    return [crc32(data) % buckets, *[crc32(word[:n].encode(), before) % buckets for n, before in _BEFORE]]


@dataclass
class Model:
    embedding: np.ndarray  # buckets x dims
    filters: np.ndarray  # projections (width by width, place by place) x dims x filters
    bias: np.ndarray  # widths x filters
    out: np.ndarray  # widths x filters
    base: float

    @cached_property
    def _known(self) -> tuple[dict[str, int], list[np.ndarray]]:
        return {}, [np.zeros((1, len(self.filters) * self.filters.shape[2]), dtype="f4")]

    def projected(self, parts: np.ndarray) -> np.ndarray:
        """The projections of words given by their parts: words x (projections * filters)."""
        vectors = self.embedding[parts].sum(axis=1)
        return np.concatenate([vectors @ f for f in self.filters], axis=1)

    def _look_up(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        known, table = self._known
        if len(known) > KEPT_WORDS:
            known.clear()
            table[0] = table[0][:1]
        found = list(map(known.get, words))
        if None in found:
            new = list({w for w, x in zip(words, found) if x is None})
            start = len(known) + 1
            table[:] = [np.concatenate([table[0], self.projected(np.array([parts_of(w, len(self.embedding)) for w in new], dtype=np.intp))])]
            known.update(zip(new, range(start, start + len(new))))
            found = list(map(known.__getitem__, words))
        return np.array(found, dtype=np.intp), table[0]

    def score(self, texts: list[str]) -> np.ndarray:
        """0 to 1 for each text."""
        docs = [t.lower().split() for t in texts]
        ids, table = self._look_up([w for d in docs for w in d])
        places, starts, padded = _laid_out(ids, np.array([len(d) for d in docs]))
        pooled, _ = _pooled(table, padded, places, starts, self.bias, keep=False)
        raw = self.base + (pooled * self.out.reshape(-1)).sum(axis=1)
        return 1 / (1 + np.exp(-raw))


def _laid_out(ids: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places of windows, where each text's begin among them, and ids with room for the widest window after each text.

    Id 0 is no word; a text without words has one window of none.
    """
    room = max(WIDTHS) - 1
    windows = np.maximum(lengths, 1)
    starts = np.concatenate([[0], np.cumsum(windows)])[:-1].astype(np.intp)
    offsets = np.arange(len(lengths)) * room
    places = np.arange(windows.sum()) + np.repeat(offsets, windows)
    padded = np.zeros(windows.sum() + room * len(lengths), dtype=np.intp)
    padded[places[np.repeat(lengths > 0, windows)]] = ids
    return places, starts, padded


#: Windows whose filter values are held at once when scoring.
AT_ONCE = 1 << 16


def _tops(table, padded, places, starts, width: int, k: int, n: int, keep: bool) -> tuple[np.ndarray, np.ndarray | None]:
    """Texts x filters: the largest value of each filter of one width, some windows at a time; with keep, also the first
    windows that have them."""
    top = np.full((len(starts), n), -np.inf, dtype="f4")
    winners = np.zeros((len(starts), n), dtype=np.intp) if keep else None
    for low in range(0, len(places), AT_ONCE):
        some = places[low : low + AT_ONCE]
        value = table[padded[some], k * n : (k + 1) * n]
        for j in range(1, width):
            value = value + table[padded[some + j], (k + j) * n : (k + j + 1) * n]
        first, last = np.searchsorted(starts, low, side="right") - 1, np.searchsorted(starts, low + len(some))
        begins = np.maximum(starts[first:last] - low, 0)
        here = np.maximum.reduceat(value, begins, axis=0)
        if keep:
            where, f = np.nonzero(value == np.repeat(here, np.diff(np.append(begins, len(some))), axis=0))
            text = np.searchsorted(begins, where, side="right") - 1
            _, at = np.unique(text * n + f, return_index=True)
            winners[first:last] = np.where(here > top[first:last], where[at].reshape(here.shape) + low, winners[first:last])
        top[first:last] = np.maximum(top[first:last], here)
    return top, winners


def _pooled(table, padded, places, starts, bias, keep: bool):
    """Texts x (widths * filters): the largest value of each filter, cut at 0; with keep, also the windows that have them."""
    n, pooled, winners, k = bias.shape[1], [], [], 0
    for i, width in enumerate(WIDTHS):
        top, where = _tops(table, padded, places, starts, width, k, n, keep)
        winners.append(where)
        pooled.append(np.maximum(top + bias[i], 0))
        k += width
    return np.concatenate(pooled, axis=1), winners


def fresh(buckets: int = 1 << 15, dims: int = 12, filters: int = 8, seed: int = 5) -> Model:
    """A model that has learned nothing."""
    rng = np.random.default_rng(seed)
    return Model(rng.normal(0, 0.1, (buckets, dims)).astype("f4"), rng.normal(0, 0.3, (sum(WIDTHS), dims, filters)).astype("f4"), np.zeros((len(WIDTHS), filters), dtype="f4"), rng.normal(0, 0.3, (len(WIDTHS), filters)).astype("f4"), 0.0)


class Learner:
    """A model in training, both labels weighing the same. Adam on the dense parts, its row-wise form on embeddings.

    share: the share of label 1 among all rows. Numbers of words are forgotten above KEPT_WORDS, so that a learner's
    memory doesn't grow with its rows.
    """

    DENSE = ("filters", "bias", "out")

    def __init__(self, model: Model, share: float, rate: float = 0.01):
        self.model, self.share, self.rate, self.step = model, share, rate, 0
        self.first = {k: np.zeros_like(getattr(model, k)) for k in self.DENSE}
        self.second = {k: np.zeros_like(getattr(model, k)) for k in self.DENSE}
        self.rows_second, self.touches = np.zeros(len(model.embedding), dtype="f4"), np.zeros(len(model.embedding), dtype="f4")
        self._words: dict[str, list[int]] = {}

    def learn(self, texts: list[str], labels: list[int]) -> None:
        """One step over some texts."""
        m, rate = self.model, self.rate
        filters, dims = m.bias.shape[1], m.embedding.shape[1]
        if len(self._words) > KEPT_WORDS:
            self._words.clear()
        docs = [t.lower().split() for t in texts]
        words = list(chain.from_iterable(docs))
        numbers = {w: k for k, w in enumerate(dict.fromkeys(words))}
        for w in numbers:
            if w not in self._words:
                self._words[w] = parts_of(w, len(m.embedding))
        parts = np.fromiter(chain.from_iterable(map(self._words.__getitem__, numbers)), dtype=np.intp, count=len(numbers) * (1 + len(STEMS))).reshape(len(numbers), 1 + len(STEMS))
        y = np.array(labels, dtype="f4")
        weight = np.where(y > 0, 0.5 / max(self.share, 1e-6), 0.5 / max(1 - self.share, 1e-6)).astype("f4")
        self.step += 1
        lengths = np.array([len(d) for d in docs])
        flat = np.fromiter(map(numbers.__getitem__, words), dtype=np.intp, count=len(words))
        vectors = np.concatenate([np.zeros((1, dims), dtype="f4"), m.embedding[parts].sum(axis=1)])
        table = np.concatenate([vectors @ f for f in m.filters], axis=1)
        places, starts, padded = _laid_out(flat + 1, lengths)
        pooled, winners = _pooled(table, padded, places, starts, m.bias, keep=True)
        raw = m.base + (pooled * m.out.reshape(-1)).sum(axis=1)
        error = (1 / (1 + np.exp(-raw)) - y) * weight / len(texts)
        back = (error[:, None] * m.out.reshape(-1)) * (pooled > 0)
        grads = {"out": (error @ pooled).reshape(m.out.shape), "bias": back.sum(axis=0).reshape(m.bias.shape), "filters": np.zeros_like(m.filters)}
        on_vectors, k = np.zeros_like(vectors), 0
        for i, width in enumerate(WIDTHS):
            g = back[:, i * filters : (i + 1) * filters]
            for j in range(width):
                word = padded[places[winners[i]] + j]
                for f in range(filters):
                    grads["filters"][k + j, :, f] = g[:, f] @ vectors[word[:, f]]
                    np.add.at(on_vectors, word[:, f], g[:, f, None] * m.filters[k + j, :, f])
            k += width
        for name in self.DENSE:
            self.first[name] = 0.9 * self.first[name] + 0.1 * grads[name]
            self.second[name] = 0.999 * self.second[name] + 0.001 * grads[name] ** 2
            v = getattr(m, name)
            v -= rate * (self.first[name] / (1 - 0.9**self.step)) / (np.sqrt(self.second[name] / (1 - 0.999**self.step)) + 1e-8)
        m.base -= rate * float(error.sum())
        touched = np.flatnonzero(np.abs(on_vectors[1:]).sum(axis=1))
        where = parts[touched].reshape(-1)
        g = np.repeat(on_vectors[1:][touched], parts.shape[1], axis=0)
        np.add.at(self.rows_second, where, (g**2).mean(axis=1))
        np.add.at(self.touches, where, 1)
        np.add.at(m.embedding, where, -5 * rate * g / (np.sqrt(self.rows_second[where])[:, None] + 1e-6))

    def _arrays(self) -> list[np.ndarray]:
        return [self.model.embedding, self.rows_second, self.touches, *(x[k] for k in self.DENSE for x in (vars(self.model), self.first, self.second))]

    def packed(self) -> bytes:
        return np.concatenate([*(x.reshape(-1) for x in self._arrays()), [self.model.base, self.step]]).astype("f4").tobytes()

    def unpacked(self, data: bytes) -> Learner:
        """A learner of the same shapes with the state that was packed."""
        flat, at = np.frombuffer(data, dtype="f4"), 0
        out = Learner(Model(*(np.zeros_like(getattr(self.model, k)) for k in ("embedding", *self.DENSE)), float(flat[-2])), self.share, self.rate)
        for x in out._arrays():
            x.reshape(-1)[:] = flat[at : at + x.size]
            at += x.size
        out.step = int(flat[-1])
        return out

    def joined(self, learned: list[tuple[int, Learner]]) -> Learner:
        """What learners that all went on from this one, over so many rows each, have learned together.

        Dense parts are averaged by rows; a bucket's vector by how often each learner has changed it, so that what only
        one of them has seen isn't diluted.
        """
        if len(learned) == 1:
            return learned[0][1]
        out, rows = self.unpacked(self.packed()), sum(n for n, _ in learned)
        changes = [x.touches - self.touches for _, x in learned]
        whole = np.maximum(sum(changes), 1)
        for (_, x), c in zip(learned, changes):
            out.model.embedding += (c / whole)[:, None] * (x.model.embedding - self.model.embedding)
            out.rows_second += x.rows_second - self.rows_second
            out.touches += c
        for mine, theirs in zip(out._arrays()[3:], zip(*(x._arrays()[3:] for _, x in learned))):
            mine[:] = sum(n / rows * x for (n, _), x in zip(learned, theirs))
        out.model.base = sum(n / rows * x.model.base for n, x in learned)
        out.step = max(x.step for _, x in learned)
        return out


def fit(texts: list[str], labels: list[int], buckets: int = 1 << 15, dims: int = 12, filters: int = 8, epochs: int = 8, batch: int = 64, rate: float = 0.01, seed: int = 5) -> Model:
    """Trains on whole texts in memory, epochs times over all of them in a random order."""
    rng = np.random.default_rng(seed + 1)
    learner = Learner(fresh(buckets, dims, filters, seed), float(np.mean(labels)), rate)
    for _ in range(epochs):
        order = rng.permutation(len(texts))
        for at in range(0, len(order), batch):
            chosen = order[at : at + batch]
            learner.learn([texts[i] for i in chosen], [labels[i] for i in chosen])
    return learner.model


def calibrated(scores: np.ndarray, labels: np.ndarray, langs: list[str | None], least: int = 20, counts: np.ndarray | None = None) -> dict[str, float]:
    """For each language the threshold of the best F1; 0.5 where fewer than `least` rows of either label are known.

    With counts, an entry stands for so many rows, of which labels says how many are toxic.
    """
    out = {}
    counts = np.ones(len(labels), dtype="i8") if counts is None else counts
    for lang in {x for x in langs if x is not None}:
        at = np.array([x == lang for x in langs])
        s, t, n = scores[at], labels[at], counts[at]
        if min(t.sum(), n.sum() - t.sum()) < least:
            continue
        order = np.argsort(-s, kind="stable")
        hits = np.cumsum(t[order])
        f1 = 2 * hits / (np.cumsum(n[order]) + t.sum())
        last = np.append(s[order][1:] < s[order][:-1], True)  # a threshold can't part equal scores
        best = int(np.argmax(np.where(last, f1, -1)))
        below = s[order][best + 1] if best + 1 < len(t) else 0.0
        out[lang] = float(np.clip((s[order][best] + below) / 2, 1e-3, 1 - 1e-3))
    return out


#: Bytes of text of each label that training_rows() collects. toxicity() itself learns from all labelled rows.
MOST_BYTES = 64 << 20
#: Rows of one learner, up to LEARNERS of them; texts and bytes of a step; rows that are seen in all, in 2 to 8 passes.
LEARNER_ROWS, LEARNERS, BATCH, BATCH_BYTES, SEEN_ROWS = 10_000, 16, 64, 2 << 20, 40_000


def training_rows(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, lang_col: str, rows_per_label: int, fold: str, bytes_per_label: int = MOST_BYTES) -> list:
    """At most rows_per_label labelled rows of each label whose fold, crc32 of the id as text modulo 5, satisfies `fold`.

    They are chosen by a hash of the id among the labels alone, and in that order as long as their texts have
    bytes_per_label bytes together; a longer text is passed over, never cut. Of an id that labels have twice the larger
    label counts; of an id that documents have twice, the smallest text and language.
    """
    known = labels.select(F.col(id_col).alias("_id"), F.col("toxic").cast("int").alias("_toxic")).where("_id is not null and _toxic is not null")
    known = known.groupBy("_id").agg(F.max("_toxic").alias("_toxic")).where(f"crc32(cast(_id as string)) % 5 {fold}").withColumn("_order", F.xxhash64("_id"))
    draw = lambda y: known.where(F.col("_toxic") == y).orderBy("_order", "_id").limit(rows_per_label)
    chosen = F.broadcast(draw(1).union(draw(0)))  # 2 * rows_per_label rows of three numbers
    texts = docs.select(F.col(id_col).alias("_id"), F.struct(whole_text(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang")).alias("_row"))
    found = written(texts.join(chosen, "_id").groupBy("_id", "_toxic", "_order").agg(F.min("_row").alias("_row")), "toxic-sample")
    room, wanted = {0: bytes_per_label, 1: bytes_per_label}, []
    for r in found.select("_id", "_toxic", "_order", F.octet_length("_row.text").alias("n")).orderBy("_order", "_id").collect():
        if r["n"] <= room[r["_toxic"]]:
            room[r["_toxic"]] -= r["n"]
            wanted.append(r["_id"])
    rows = found.where(F.col("_id").isin(wanted)).select("_id", "_row.text", "_row.lang", F.col("_toxic").alias("toxic")).collect()
    return sorted(rows, key=lambda r: r["_id"])


def labelled_rows(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, lang_col: str) -> DataFrame:
    """(_id, toxic, fold, text, lang) of every labelled row that isn't held out, written.

    Of an id that labels have twice the larger label counts; of an id that documents have twice, the smallest text and
    language.
    """
    fold = F.crc32(F.col("_id").cast("string")) % 5
    known = labels.select(F.col(id_col).alias("_id"), F.col("toxic").cast("int").alias("toxic")).where("_id is not null and toxic in (0, 1)").where(fold > 0)
    known = known.groupBy("_id").agg(F.max("toxic").alias("toxic"))
    texts = docs.select(F.col(id_col).alias("_id"), F.struct(whole_text(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang")).alias("row")).where(fold > 0)
    found = texts.join(known, "_id").groupBy("_id", "toxic").agg(F.min("row").alias("row"))
    return written(found.select("_id", "toxic", fold.cast("int").alias("fold"), F.col("row.text").cast("binary").alias("text"), "row.lang"), "toxic-labelled")


def _one_pass(batches, learner: Learner):
    """(shard, n, state) of a learner for each shard; rows come in the order of shards."""
    shard, own, rows, texts, labels, held = None, None, 0, [], [], 0

    def step():
        nonlocal texts, labels, held
        if texts:
            own.learn(texts, labels)
        texts, labels, held = [], [], 0

    def done():
        return pa.RecordBatch.from_arrays([pa.array([shard], pa.int32()), pa.array([rows], pa.int64()), pa.array([own.packed()], pa.binary())], ["shard", "n", "state"])

    for batch in batches:
        for at, toxic, text in zip(batch.column("shard").to_pylist(), batch.column("toxic").to_pylist(), batch.column("text")):
            if at != shard:
                if own:
                    step()
                    yield done()
                shard, own, rows = at, learner.unpacked(learner.packed()), 0
            data = text.as_py()
            texts.append(data.decode("utf-8", "replace"))
            labels.append(toxic)
            rows, held = rows + 1, held + len(data)
            if len(texts) == BATCH or held >= BATCH_BYTES:
                step()
    if own:
        step()
        yield done()


def trained(rows: DataFrame) -> Model | None:
    """A model that has learned from all rows (_id, toxic, text); None without rows of both labels.

    Rows are dealt to learners by a hash of the id, one for each LEARNER_ROWS of them; after each pass over all rows what
    they have learned is joined, and all go on from there. Each pass has another order of rows, by a hash of id and pass,
    so that the model depends neither on partitions nor on their order. Fewer rows are passed over more often.
    """
    n, ones = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    if not 0 < ones < n:
        return None
    shards = max(1, min(LEARNERS, round(n / LEARNER_ROWS)))
    learner = Learner(fresh(), ones / n)
    for k in range(max(2, min(8, round(SEEN_ROWS / n)))):
        shard = F.pmod(F.xxhash64("_id"), F.lit(shards)).cast("int")
        dealt = rows.select(shard.alias("shard"), F.xxhash64("_id", F.lit(k)).alias("order"), "_id", "toxic", "text").repartition(4 * shards, "shard").sortWithinPartitions("shard", "order", "_id")
        found = map_batches(dealt.select("shard", "toxic", "text"), lambda batches, learner=learner: _one_pass(batches, learner), "shard int, n long, state binary").collect()
        learner = learner.joined([(r["n"], learner.unpacked(r["state"])) for r in sorted(found, key=lambda r: r["shard"])])
    return learner.model


def thresholds_of(rows: DataFrame, model: Model) -> tuple[float, dict[str, float]]:
    """The best threshold of all rows (toxic, text, lang), and by language the best of the scores that are moved so that
    the first is 0.5. All rows count, by language and hundredths of the score's logit."""

    def scored(batches):
        for batch in batches:
            score = np.concatenate([_scores(model, batch.column("text").slice(a, b - a)) for a, b in slices(batch.column("text"), 2 << 20)] or [np.zeros(0)])
            yield pa.RecordBatch.from_arrays([batch.column("lang"), batch.column("toxic"), pa.array(score)], ["lang", "toxic", "score"])

    found = map_batches(rows.select("lang", "toxic", "text"), scored, "lang string, toxic int, score double")
    s = F.greatest(F.lit(1e-7), F.least(F.lit(1 - 1e-7), F.col("score")))
    counts = written(found.groupBy("lang", F.round(100 * F.ln(s / (1 - s))).cast("int").alias("at")).agg(F.sum("toxic").alias("ones"), F.count(F.lit(1)).alias("n")), "toxic-scores")
    every = counts.groupBy("at").agg(F.sum("ones").alias("ones"), F.sum("n").alias("n")).collect()
    table = lambda rows: (np.array([r["at"] / 100 for r in rows]), np.array([r["ones"] for r in rows]), np.array([r["n"] for r in rows]))
    at, ones, n = table(every)
    middle = calibrated(1 / (1 + np.exp(-at)), ones, ["all"] * len(every), counts=n).get("all", 0.5) if every else 0.5
    enough = counts.groupBy("lang").agg(F.sum("ones").alias("ones"), F.sum("n").alias("n")).where("lang is not null and ones >= 20 and n - ones >= 20")
    by = counts.join(enough.select("lang"), "lang", "left_semi").collect()
    at, ones, n = table(by)
    moved = 1 / (1 + np.exp(np.log(middle / (1 - middle)) - at))
    return middle, calibrated(moved, ones, [r["lang"] for r in by], counts=n) if by else {}


def _scores(model: Model, column: pa.Array) -> np.ndarray:
    return model.score([t.decode("utf-8", "replace") for t in column.to_pylist()]).astype("f8")


def toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """One row per input row: id_col, held_out, score, predicted, threshold, flagged.

    The score is a function of the text alone; null counts as empty. Rows whose fold is 0 are held out: their labels are
    never read. Fold 1 calibrates the thresholds of languages, folds 2 to 4 train, with all their labelled rows.
    predicted is 1 from a score of 0.5 on, flagged from the language's threshold on. Without labelled rows of both kinds
    all scores are 0. A null id is held out: there is no hash to place it. Repeated rows are rows like others; an empty
    table gives none. A very long text is scored, and learned from, whole, AT_ONCE windows at a time.
    """
    known = labelled_rows(docs, labels, id_col, text_col, lang_col)
    model, thresholds = trained(known.where("fold > 1")), {}
    if model:
        middle, thresholds = thresholds_of(known.where("fold = 1"), model)
        model.base -= float(np.log(middle / (1 - middle)))  # one threshold for all scores: 0.5
        model.__dict__.pop("_known", None)

    def scored(batches):
        for batch in batches:
            column, out = batch.column("text"), []
            for start, stop in slices(column, 2 << 20):
                out.append(_scores(model, column.slice(start, stop - start)) if model else np.zeros(stop - start))
            score = np.concatenate(out).astype("f8") if out else np.zeros(0)
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("lang"), pa.array(score)], ["id", "lang", "score"])

    pairs = docs.select(F.col(id_col).alias("id"), F.col(lang_col).cast("string").alias("lang"), whole_text(text_col).cast("binary").alias("text"))
    found = map_batches(pairs, scored, f"id {id_type(docs, id_col)}, lang string, score double")
    threshold = F.lit(0.5)
    for lang, x in sorted(thresholds.items()):
        threshold = F.when(F.col("lang") == lang, x).otherwise(threshold)
    fold = F.crc32(F.col("id").cast("string")) % 5
    return found.select(F.col("id").alias(id_col), F.coalesce(fold == 0, F.lit(True)).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), threshold.alias("threshold"), (F.col("score") >= threshold).alias("flagged"))
