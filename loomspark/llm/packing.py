"""Best-fit packing of tokenised documents into sequences, by a grouping genetic algorithm on islands.

Pieces of one length are alike, so a packing is a multiset of patterns: which lengths share a sequence, and how often.
The problem is then the histogram of lengths, at most `capacity` numbers for any corpus, and every island sees all of it.
Crossover injects whole well-filled sequences of one parent into the other, removes the sequences that would use a piece
twice, and best-fits the pieces that this displaces. After each epoch every island's elite moves on to the next island.
Pieces are numbered within their length by counts of partitions, and a piece's number gives its sequence and offset.
"""

from __future__ import annotations

import json
import logging
import random
import re
import zlib
from bisect import bisect_right
from collections import Counter
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .bpe import Bpe, default_vocabulary
from .common import id_type, map_batches, reach_workers, slices, whole_text, written

Pattern = tuple[int, ...]
Packing = dict[Pattern, int]
_log = logging.getLogger(__name__)

#: Runs of this length go to the plain encoder: the fast one's regular expressions recurse on them.
LONG_RUN = re.compile(r"\S{20000}|\s{20000}")


# --- lengths into patterns -----------------------------------------------------------------------------------------


def best_fit(counts: dict[int, int], capacity: int, rng: random.Random | None = None, loose: float = 0.0) -> Packing:
    """A packing of the pieces that counts gives by length: the longest first, then always the longest that still fits.

    With rng, each choice after the first is, with probability loose, the next shorter length.
    """
    left = {z: n for z, n in counts.items() if n > 0}
    sizes = sorted(left)
    out: Packing = Counter()
    while sizes:
        taken: Counter[int] = Counter()
        room, top = capacity, len(sizes)
        while room and top:
            top = min(top, bisect_right(sizes, room))
            while top and left[sizes[top - 1]] <= taken[sizes[top - 1]]:
                top -= 1
            if not top:
                break
            at = top - 1
            if rng and taken and at and rng.random() < loose and left[sizes[at - 1]] > taken[sizes[at - 1]]:
                at -= 1
            taken[sizes[at]] += 1
            room -= sizes[at]
        times = min(left[z] // k for z, k in taken.items())
        out[tuple(sorted(taken.elements(), reverse=True))] += times
        for z, k in taken.items():
            left[z] -= k * times
            if not left[z]:
                del left[z]
                sizes.pop(bisect_right(sizes, z) - 1)
    return out


def exact_fit(counts: dict[int, int], capacity: int, rng: random.Random, steady: float = 1.0) -> Packing:
    """A packing in which each sequence has the longest piece left and, of all sets of pieces that fit beside it, one that
    leaves the least room, by sums that are reachable. Long pieces go first; less so the less steady it is."""
    left = {z: n for z, n in counts.items() if n > 0}
    out: Packing = Counter()
    while left:
        first = max(left)
        room = capacity - first
        mask, reach, steps = (1 << room + 1) - 1, 1, []
        for z in sorted((z for z in left if z <= room), key=lambda z: -z * rng.uniform(steady, 1)):
            spare, copies = min(left[z] - (z == first), room // z), 1
            while spare > 0:
                k = min(copies, spare)
                steps.append((z, k, reach))
                reach |= reach << z * k & mask
                spare, copies = spare - k, 2 * copies
            if reach >> room & 1:
                break
        taken, total = Counter({first: 1}), reach.bit_length() - 1
        for z, k, before in reversed(steps):
            if not before >> total & 1:
                taken[z] += k
                total -= z * k
        times = min(left[z] // k for z, k in taken.items())
        out[tuple(sorted(taken.elements(), reverse=True))] += times
        for z, k in taken.items():
            left[z] -= k * times
            if not left[z]:
                del left[z]
    return out


def least_bins(counts: dict[int, int], capacity: int) -> int:
    """A number of sequences that no packing goes below.

    Pieces over half the capacity each have a sequence of their own; what of the shorter ones doesn't fit beside those
    that leave room for them needs more. The bound is the best over where shorter ones are taken to begin.
    """
    n, total = [0] * (capacity + 2), [0] * (capacity + 2)  # of pieces of at least z
    for z in range(capacity, 0, -1):
        n[z], total[z] = n[z + 1] + counts.get(z, 0), total[z + 1] + z * counts.get(z, 0)
    half, best = capacity // 2 + 1, -(-total[1] // capacity)
    for k in range(1, capacity // 2 + 1):
        whole = n[capacity - k + 1]  # no piece of k or more fits beside these
        beside, used = n[half] - whole, total[half] - total[capacity - k + 1]
        rest = total[k] - total[half] - (beside * capacity - used)
        best = max(best, whole + beside + max(0, -(-rest // capacity)))
    return best


def bins(packing: Packing) -> int:
    return sum(packing.values())


def worth(packing: Packing, capacity: int) -> tuple[int, float]:
    """Less is better: the number of sequences, then how evenly they are filled."""
    return bins(packing), -sum(m * (sum(p) / capacity) ** 2 for p, m in packing.items())


def _usable(pattern: Pattern, times: int, left: dict[int, int]) -> int:
    return min(times, *(left.get(z, 0) // k for z, k in Counter(pattern).items()))


def _take(child: Packing, pattern: Pattern, times: int, left: dict[int, int]) -> None:
    if times > 0:
        child[pattern] += times
        for z in pattern:
            left[z] -= times


def _insert(child: Packing, left: dict[int, int], capacity: int, rng: random.Random, loose: float, exact: bool = False) -> Packing:
    """Best-fits what is left, first into room that sequences still have, then into new ones (exact: by exact_fit)."""
    sizes = sorted(z for z, n in left.items() if n > 0)
    for pattern in sorted(child, key=sum) if not exact else ():
        if not sizes:
            break
        while (times := child.get(pattern, 0)) and (at := bisect_right(sizes, capacity - sum(pattern))):
            z = sizes[at - 1]
            k = min(times, left[z])
            child[pattern] -= k
            pattern_with = tuple(sorted((*pattern, z), reverse=True))
            child[pattern_with] += k
            left[z] -= k
            if not left[z]:
                sizes.pop(at - 1)
            if k == times:
                del child[pattern]
                pattern = pattern_with
    child.update(exact_fit(left, capacity, rng, rng.uniform(0.3, 1)) if exact else best_fit(left, capacity, rng, loose))
    return Counter({p: m for p, m in child.items() if m})


def crossover(a: Packing, b: Packing, counts: dict[int, int], capacity: int, rng: random.Random) -> Packing:
    """Whole well-filled sequences of b go into a; a's sequences that would use a piece twice are removed, and what that
    displaces is fitted anew."""
    left, child = dict(counts), Counter()
    filled = sorted(b, key=sum, reverse=True)
    for pattern in filled[: max(1, int(len(filled) * rng.uniform(0.2, 0.6)))]:
        if rng.random() < 0.7:
            _take(child, pattern, _usable(pattern, b[pattern], left), left)
    for pattern in sorted(a, key=sum, reverse=True):
        _take(child, pattern, _usable(pattern, a[pattern], left), left)
    return _insert(child, left, capacity, rng, rng.choice((0.0, 0.05)), rng.random() < 0.5)


def mutated(a: Packing, counts: dict[int, int], capacity: int, rng: random.Random) -> Packing:
    """Dissolves the emptiest sequences, so many that one fewer could do, and some full ones; fits their pieces anew."""
    child, left = Counter(a), Counter()

    def dissolve(pattern: Pattern, times: int) -> None:
        child[pattern] -= times
        for z in pattern:
            left[z] += times

    room = int(capacity * rng.uniform(1, 3))
    for pattern in sorted(a, key=sum):
        free = capacity - sum(pattern)
        if room <= 0 or not free:
            break
        times = min(a[pattern], -(-room // free))
        dissolve(pattern, times)
        room -= times * free
    full = [p for p in child if child[p] > 0]
    for pattern in rng.sample(full, min(len(full), rng.randint(1, 12))):
        dissolve(pattern, rng.randint(1, min(child[pattern], 4)))
    return _insert(+child, left, capacity, rng, 0.05, rng.random() < 0.8)


def _encode_packing(packing: Packing) -> str:
    return json.dumps([[list(p), m] for p, m in sorted(packing.items())])


def _decode_packing(text: str) -> Packing:
    return Counter({tuple(p): m for p, m in json.loads(text)})


def evolve(population: list[Packing], counts: dict[int, int], capacity: int, generations: int, size: int, rng: random.Random) -> list[Packing]:
    """The best `size` packings after some generations, best first. It ends when no packing can have fewer sequences."""
    least, key = least_bins(counts, capacity), lambda p: worth(p, capacity)
    while len(population) < size:
        k = len(population)
        population.append(exact_fit(counts, capacity, rng, 1 - k / size) if k % 2 else best_fit(counts, capacity, rng, 0.1 * k / size))
    population.sort(key=key)
    for _ in range(generations):
        if bins(population[0]) <= least:
            break
        a, b = (min(rng.sample(range(len(population)), 2)) for _ in range(2))
        child = mutated(population[a], counts, capacity, rng) if a == b or rng.random() < 0.5 else crossover(population[a], population[b], counts, capacity, rng)
        if child not in population:
            population = sorted([*population, child], key=key)[:size]
    return population


def budget(counts: dict[int, int], gap: int) -> int:
    """Generations of an island in one epoch: more the more lengths there are and the further the bound is."""
    return 100 + len(counts) // 4 + 20 * min(gap, 20)


def pack_counts(spark, counts: dict[int, int], capacity: int, islands: int = 6, most_epochs: int = 6, population: int = 6) -> Packing:
    """The best packing that any island finds. counts has at most `capacity` entries, whatever the corpus.

    Best fit comes first; where it meets the bound there is nothing to search. Islands go on in epochs until one meets
    the bound, or two epochs in a row save nothing; after each, elites move on. What the search saves is logged.
    """
    reach_workers(spark)
    start, least = best_fit(counts, capacity), least_bins(counts, capacity)
    best, still, epoch, state = start, 0, 0, None

    def island(epoch: int, generations: int):
        def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
            rng = random.Random(f"{epoch}:{key[0]}")
            found = evolve([_decode_packing(x) for x in sorted(rows["packing"]) if x], counts, capacity, generations, population, rng)
            return pd.DataFrame({"island": key[0], "place": range(len(found)), "sequences": [bins(p) for p in found], "packing": [_encode_packing(p) for p in found]})

        return run

    schema = "island long, place long, sequences long, packing string"
    while bins(best) > least and epoch < most_epochs and still < 2:
        if state is None:
            state = spark.createDataFrame([(k, _encode_packing(start)) for k in range(islands)], "island long, packing string")
        else:
            elite = state.where("place = 0").select(((F.col("island") + 1) % islands).alias("island"), "packing")
            state = state.select("island", "packing").union(elite)
        state = written(state.groupBy("island").applyInPandas(island(epoch, budget(counts, bins(best) - least)), schema), "packing-islands")
        found = _decode_packing(state.orderBy("sequences", "place", "island").first()["packing"])
        still = 0 if bins(found) < bins(best) else still + 1
        best, epoch = min(best, found, key=bins), epoch + 1
    _log.info("best fit has %d sequences, %d epochs on islands left %d; no packing has under %d", bins(start), epoch, bins(best), least)
    return best


# --- documents into pieces, pieces into sequences ------------------------------------------------------------------


@cache
def _coders(path: str) -> tuple[Bpe, tiktoken.Encoding]:
    own = Bpe(path)
    return own, tiktoken.Encoding(path, pat_str=Bpe.SPLIT, mergeable_ranks=own.ids, special_tokens=own.special)


def token_ids(path: str, text: str) -> np.ndarray:
    own, fast = _coders(path)
    if LONG_RUN.search(text):
        return np.frombuffer(own.encode([text])[0], dtype="<u4")
    return fast.encode_to_numpy(text, allowed_special="all")


def _pieces(batches, path: str, capacity: int, end_id: int, keep_ids: bool):
    part, ranks = TaskContext.get().partitionId(), Counter()
    end = np.array([end_id], dtype="<u4")
    for batch in batches:
        column = batch.column("text")
        for start, stop in slices(column, 4 << 20):
            rows: list[tuple] = []
            parents, tokens = [], []
            for k, text in enumerate(column.slice(start, stop - start).to_pylist(), start):
                ids = np.concatenate([token_ids(path, text.decode("utf-8", "replace")), end]).astype("<u4")
                at, until = 0, (len(ids) - 1) % capacity + 1
                piece = 0
                while at < len(ids):
                    part_ids = ids[at:until]
                    n = until - at
                    rows.append((piece, at, n, zlib.crc32(part_ids.tobytes()), part, ranks[n]))
                    parents.append(k)
                    if keep_ids:
                        tokens.append(part_ids.astype("i4"))
                    ranks[n] += 1
                    piece, at, until = piece + 1, until, until + capacity
            columns = [batch.column("id").take(pa.array(parents, pa.int64())), *(pa.array(x, pa.int64()) for x in zip(*rows))]
            names = ["id", "piece", "start", "length", "ids_crc32", "part", "local"]
            if keep_ids:
                columns.append(pa.array(tokens, pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names)


def pieces(docs: DataFrame, id_col: str, text_col: str, capacity: int, end_id: int, vocabulary: str, keep_ids: bool) -> DataFrame:
    """Each document's pieces; part and local number the pieces of one length within a partition."""
    schema = f"id {id_type(docs, id_col)}, piece long, start long, length long, ids_crc32 long, part long, local long" + ", ids array<int>" * keep_ids
    pairs = docs.select(F.col(id_col).alias("id"), whole_text(text_col).cast("binary").alias("text"))
    return map_batches(pairs, lambda batches: _pieces(batches, vocabulary, capacity, end_id, keep_ids), schema)


def _slots(packing: Packing) -> np.ndarray:
    """Rows (length, first number, sequence of that number, offset), sorted: consecutive numbers have consecutive sequences."""
    used: Counter[int] = Counter()
    rows, sequence = [], 0
    for pattern, times in sorted(packing.items(), reverse=True):
        offset = 0
        for z in pattern:
            rows.append((z, used[z], sequence, offset))
            used[z] += times
            offset += z
        sequence += times
    return np.array(sorted(rows) or [(0, 0, 0, 0)], dtype="i8")


def pack_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = 1024, end_id: int = 2, vocabulary: str | None = None, islands: int = 6, most_epochs: int = 6, population: int = 6, keep_ids: bool = True) -> DataFrame:
    """One row per piece: id_col, piece, start, length, ids_crc32, sequence_id, offset and, if keep_ids, ids.

    A document is its ids, then end_id. Only one of over `capacity` ids is cut, the first piece being the shorter. A
    null or empty text is end_id alone. Sequences are gapless from offset 0. Repeated rows, ties and null ids are rows
    like others; an empty table gives none. Which of two pieces of one length stands where is arbitrary. A very long
    text is tokenised whole, in one task, which holds its ids.
    """
    spark = docs.sparkSession
    cut = written(pieces(docs, id_col, text_col, capacity, end_id, vocabulary or default_vocabulary(), keep_ids), "packing-pieces")
    counts = {r["length"]: r["count"] for r in cut.groupBy("length").count().collect()}  # `capacity` rows at most
    packing = pack_counts(spark, counts, capacity, islands, most_epochs, population) if counts else Counter()
    slots = _slots(packing)
    keys = (slots[:, 0] << 44) + slots[:, 1]

    before = W.partitionBy("length").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    bases = cut.groupBy("length", "part").count().select("length", "part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("base"))

    def placed(batches):
        for batch in batches:
            number = batch.column("local").to_numpy() + batch.column("base").to_numpy()
            at = np.searchsorted(keys, (batch.column("length").to_numpy() << 44) + number, side="right") - 1
            sequence, offset = slots[at, 2] + number - slots[at, 1], slots[at, 3]
            out = [batch.column(n) for n in ("id", "piece", "start", "length", "ids_crc32")]
            names = ["id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
            if keep_ids:
                names.append("ids")
            yield pa.RecordBatch.from_arrays([*out, pa.array(sequence), pa.array(offset), *([batch.column("ids")] if keep_ids else [])], names)

    schema = f"id {id_type(docs, id_col)}, piece long, start long, length long, ids_crc32 long, sequence_id long, offset long" + ", ids array<int>" * keep_ids
    return map_batches(cut.join(bases, ["length", "part"]), placed, schema).withColumnRenamed("id", id_col)
