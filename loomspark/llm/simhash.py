"""SimHash near-duplicates, found by anchor points of a covering code.

Of two fingerprints that differ in at most three bits, one 32-bit half differs in at most one. In each half the anchors
are the words of the Hamming code of length 31, radius 1, with the last bit free: every half word is within one bit of
exactly one anchor, its home. A fingerprint is replicated to all anchors within radius plus threshold, two bits; so the
home of one of the two is among the anchors of the other, and they are compared there. Only distinct fingerprints take
part, and those that one cheap key joins into a class need no more comparing: within an anchor, members of the class
that most of its homes have are never paired with each other, so that a large group of copies stays linear.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.components import components
from ..operators.skew import hot_join
from .common import id_type, map_batches, row_number, steady, whole_text, without_rows, written

_LOWER = bytes(range(0x41)) + bytes(range(0x61, 0x7B)) + bytes(range(0x5B, 0x100))
#: Shingle hashes whose bits are counted at once.
_AT_ONCE = 1 << 16
BITS, RADIUS = 31, 1


def fingerprint(data: bytes, words_in_shingle: int = 3, seed: int = 42) -> int:
    """The 64 majority bits of the hashes of all shingles, repeats included; 0 without a word."""
    words = data.translate(_LOWER).split()
    if not words:
        return 0
    k = min(words_in_shingle, len(words))
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])[: len(words) - k + 1].tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[a:b], seed) for a, b in zip(starts, ends[k - 1 :].tolist())], dtype="<u8")
    ones = np.zeros(64, dtype="i8")
    for at in range(0, len(hashes), _AT_ONCE):
        some = hashes[at : at + _AT_ONCE]
        ones += np.unpackbits(some.view("u1").reshape(len(some), 8), axis=1, bitorder="little").sum(axis=0, dtype="i8")
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def _fingerprints(batches, words_in_shingle: int, seed: int):
    for batch in batches:
        found = np.array([fingerprint(t.as_py(), words_in_shingle, seed) for t in batch.column("text")], dtype="u8")
        yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("key"), pa.array(found.view("i8"))], ["id", "key", "fp"])


def fingerprints(docs: DataFrame, id_col: str, text_col: str, key: Column, words_in_shingle: int = 3, seed: int = 42) -> DataFrame:
    """(id, key, fp): fp is the fingerprint as a signed long."""
    rows = docs.select(F.col(id_col).alias("id"), key.alias("key"), whole_text(text_col).cast("binary").alias("text"))
    return map_batches(rows, lambda batches: _fingerprints(batches, words_in_shingle, seed), f"id {id_type(docs, id_col)}, key long, fp long")


def _syndrome(word: str) -> str:
    """SQL: the exclusive or of the positions, 1 to 31, of the ones among the low 31 bits; 0 for a code word."""
    return " + ".join(f"(bit_count({word} & {sum(1 << (p - 1) for p in range(1, BITS + 1) if p >> k & 1)}L) & 1) * {1 << k}" for k in range(5))


def _flipped(word: str, position: str) -> str:
    return f"({word} ^ shiftleft(1L, {position} - 1))"


def _anchors(half: int) -> tuple[str, str, str]:
    """SQL over fp: the half word, its home and all anchors within two bits."""
    word = "(fp & 4294967295L)" if half == 0 else "(shiftrightunsigned(fp, 32))"
    home = f"if(s{half} = 0, w{half}, {_flipped(f'w{half}', f's{half}')})"
    pairs = f"transform(filter(sequence(1, {BITS}), p -> s{half} <> 0 and p < (p ^ s{half})), p -> {_flipped(_flipped(f'w{half}', 'p'), f'(p ^ s{half})')})"
    return word, home, f"concat(array(h{half}, h{half} ^ {1 << BITS}L), {pairs})"


def _of_half(half: int):
    return lambda anchor: F.struct(F.lit(half).alias("half"), anchor.alias("anchor"))


_ANCHOR = ["half", "anchor"]


def _cross_pairs(homes: DataFrame, visits: DataFrame, threshold: int) -> DataFrame:
    """(u, v): classes of which a home (half, anchor, fp, class) and a visit (the same, other, class2) are close.

    An anchor's main class is the one that most of its homes have. Visits of that class meet only homes of other
    classes; visits of other classes meet all homes. So what isn't paired is one class at its own anchor, and anchors
    where nobody is at home are left out before that.
    """
    counts = homes.groupBy(*_ANCHOR, "class").agg(F.count(F.lit(1)).alias("c"))
    main = written(counts.groupBy(*_ANCHOR).agg(F.max_by("class", F.struct("c", "class")).alias("main"), (F.count(F.lit(1)) > 1).alias("mixed"), F.sum("c").alias("n")), "simhash-anchors")
    guests = written(hot_join(visits, main, _ANCHOR, "n").where("class2 <> main or mixed"), "simhash-visits")
    hosts = hot_join(homes, main.where("mixed"), _ANCHOR, "n").where("class <> main").select(homes.columns)
    near = (F.col("class") != F.col("class2")) & (F.bit_count(F.col("fp").bitwiseXOR(F.col("other"))) <= threshold)
    pairs = homes.join(guests.where("class2 <> main"), _ANCHOR).where(near).select("class", "class2").union(hosts.join(guests.where("class2 = main"), _ANCHOR).where(near).select("class", "class2"))
    return pairs.select(F.least("class", "class2").alias("u"), F.greatest("class", "class2").alias("v")).distinct()


def links(distinct: DataFrame, threshold: int = 3) -> DataFrame:
    """(u, v) links between distinct fingerprints (fp) that give the same components as all pairs within threshold bits.

    threshold is at most 3. First, fingerprints that agree in one half and share the other's home, and so differ in two
    bits at most, are linked to their smallest. Then those that the components so far leave apart are compared at
    their anchors.
    """
    if not 2 <= threshold <= 3:
        raise ValueError("the anchors are made for a threshold of 2 or 3 bits")
    parts = {}
    for half in (0, 1):
        word, home, near = _anchors(half)
        parts |= {f"w{half}": F.expr(word), f"s{half}": F.expr(f"cast({_syndrome(f'w{half}')} as int)"), f"h{half}": F.expr(home), f"a{half}": F.expr(near)}
    split = lambda rows: reduce(lambda df, name: df.withColumn(name, parts[name]), parts, rows)
    keys = split(distinct.select("fp")).select("fp", F.explode(F.array(*(F.struct(F.lit(h).alias("half"), F.col(f"w{h}").alias("same"), F.col(f"h{1 - h}").alias("home")) for h in (0, 1)))).alias("k")).select("fp", "k.*")
    key = ["half", "same", "home"]
    stars = written(keys.groupBy(key).agg(F.min("fp").alias("v"), F.count(F.lit(1)).alias("n")).where("n > 1"), "simhash-keys")
    starred = written(hot_join(keys, stars, key, "n").where("fp <> v").select(F.col("fp").alias("u"), "v"), "simhash-stars")
    classes = components(starred)
    # What follows reads it six times.
    of = written(distinct.select("fp").join(classes.withColumnRenamed("node", "fp"), "fp", "left").select("fp", F.coalesce("root", "fp").alias("class")), "simhash-classes")
    each = split(of)

    homes = each.select("fp", "class", F.explode(F.array(*(F.struct(F.lit(h).alias("half"), F.col(f"h{h}").alias("anchor")) for h in (0, 1)))).alias("k")).select("fp", "class", "k.*")
    visits = each.select("fp", "class", F.explode(F.concat(*(F.transform(f"a{h}", _of_half(h)) for h in (0, 1)))).alias("k")).select(F.col("fp").alias("other"), F.col("class").alias("class2"), "k.*")
    return of.where("fp <> class").select(F.col("fp").alias("u"), F.col("class").alias("v")).union(_cross_pairs(homes, visits, threshold))


def simhash_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: int = 3, words_in_shingle: int = 3, seed: int = 42, key: Column | None = None) -> DataFrame:
    """One row per input row: id_col, fingerprint (16 lowercase hex digits), component_id, _key, first.

    Words are what [\\x20\\x09-\\x0D] separates, A-Z lower-cased; with fewer words than a shingle has, all of them make one;
    without any (null, empty or blank text) the fingerprint is zero, linked like any other. component_id is the smallest
    id that links reach (nulls last). first marks one row of each component, that of the smallest id and then _key, so
    that of repeated rows one is first. An empty table gives none. A very long text is hashed whole, 65,536 shingles at
    a time. Frequent fingerprints, classes and keys meet what belongs to them by a broadcast of bounded size.
    """
    rows = written(fingerprints(docs, id_col, text_col, row_number() if key is None else key, words_in_shingle, seed), "simhash")
    classes = components(links(rows.select("fp").distinct(), threshold))
    best = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "key"))
    each = rows.groupBy("fp").agg(best.alias("b"), F.count(F.lit(1)).alias("n")).join(classes.withColumnRenamed("node", "fp"), "fp", "left").withColumn("class", F.coalesce("root", "fp"))
    each = written(each.select("fp", "class", "b", "n"), "simhash-each")
    whole = each.groupBy("class").agg(F.min("b").alias("best"), F.count(F.lit(1)).alias("members"))
    named = written(hot_join(each.select("fp", "class", "n"), whole, ["class"], "members").select("fp", "best", "n"), "simhash-named")
    return hot_join(rows, named, ["fp"], "n").select(
        F.col("id").alias(id_col),
        F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        F.col("best.id").alias("component_id"),
        F.col("key").alias("_key"),
        (F.col("best.key") == F.col("key")).alias("first"),
    )


def without_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs with one row of each component; the columns stay as they are."""
    docs = steady(docs)
    return without_rows(docs, simhash_groups(docs, id_col, text_col).where("not first"))
