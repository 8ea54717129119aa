"""Quality rules: counts that fail a document outright, then divergence from the language's references.

A reference is what a language's documents have on average: the shares of character classes among all characters, the
shares of common words among all words, and the share of the language's common words together. A document is compared
with it by Jensen-Shannon distance, if it is long enough for its shares to mean something. Shares of n words stray from
what they are drawn from by about 1 / sqrt(n), so limits have a part that shrinks like that.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WHITE_SPACE, map_batches, row_number, steady, whole_text, without_rows, written

_WS = WHITE_SPACE.encode()
_INNER = bytes(range(0x80, 0xC0))
_SYMBOLS = b"#*$%&|<>"

#: Character classes by byte. A character of two or more bytes counts by its first one, as a letter, so that a text in two
#: languages is like either; so does a digit, so that a number or two doesn't set a short text apart.
CLASSES = ("letter", "upper", "space", "newline", "point", "symbol", "control")
_CLASS = np.zeros(256, dtype=np.intp)
_CLASS[0:32], _CLASS[127] = 6, 6
_CLASS[32:127] = 4
for _k, _chars in ((0, b"abcdefghijklmnopqrstuvwxyz0123456789"), (1, b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"), (2, b" \t"), (3, b"\n\r"), (5, b"#*$%&|<>@^~`=+{}[]\\_/")):
    _CLASS[list(_chars)] = _k
_CLASS[0x80:0xC0] = len(CLASSES)  # inside a character

#: Common words of the languages that have a reference of their own: the most frequent function words of each.
COMMON = {
    "en": ("the", "of", "and", "to", "in", "a", "is", "that", "for", "it", "as", "with", "was", "on", "are", "be", "by", "this", "an", "or", "from", "at"),
    "fr": ("de", "la", "le", "et", "les", "des", "en", "un", "du", "une", "que", "est", "pour", "qui", "dans", "par", "plus", "pas", "au", "sur", "ne", "se"),
    "de": ("der", "die", "und", "in", "den", "von", "zu", "das", "mit", "sich", "des", "auf", "ist", "im", "dem", "nicht", "ein", "eine", "als", "auch", "es", "an"),
    "es": ("de", "la", "que", "el", "en", "y", "a", "los", "se", "del", "las", "un", "por", "con", "no", "una", "su", "para", "es", "al", "lo", "como"),
}
#: One column of counts for each distinct word.
WORDS = tuple(dict.fromkeys(w for words in COMMON.values() for w in words))
_PLACE = {w.encode(): k for k, w in enumerate(WORDS)}
_OWN = {lang: [WORDS.index(w) for w in words] for lang, words in COMMON.items()}
_MARKS = b".,;:!?\"'()"
_LONGEST = max(map(len, _PLACE))
#: Shares are summed as whole parts of this, so that a reference doesn't depend on the order of its documents.
UNITS = 10**12

LEAST_WORDS, MOST_REPEATED = 20, 30  # of the contract: fewer words, or a larger percentage in repeated windows, fail
WINDOW = 8
_BASE = np.uint64(0x9E3779B97F4A7C15)


def repeated_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words in windows found twice or more, the first one included."""
    n = len(words) - window + 1
    if n < 2:
        return 0
    numbers: dict[bytes, int] = {}
    ids = np.array([numbers.setdefault(w, len(numbers)) for w in words], dtype="u8")
    if len(numbers) == len(words):
        return 0
    ids = (ids + np.uint64(1)) * _BASE
    ids ^= ids >> np.uint64(29)
    hashes = np.zeros(n, dtype="u8")
    for k in range(window):
        hashes = hashes * _BASE + ids[k : k + n]
    order = np.argsort(hashes, kind="stable")
    ranked = hashes[order]
    equal = ranked[1:] == ranked[:-1]
    if not equal.any():
        return 0
    twice = np.zeros(n, dtype=bool)
    twice[order[1:][equal]] = True
    twice[order[:-1][equal]] = True
    seen: dict[tuple[bytes, ...], list[int]] = {}  # what hashes say is checked on the words themselves
    for i in np.flatnonzero(twice).tolist():
        seen.setdefault(tuple(words[i : i + window]), []).append(i)
    edges = np.zeros(len(words) + 1, dtype="i8")
    for places in seen.values():
        if len(places) > 1:
            for i in places:
                edges[i] += 1
                edges[i + window] -= 1
    return int((np.cumsum(edges[:-1]) > 0).sum())


def measures(data: bytes) -> tuple[int, int, int, int, int, list[int], list[int]]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, characters by class, common words."""
    words = data.split()
    lines: set[bytes] = set()
    repeated = 0
    for line in data.split(b"\n"):
        if line in lines:
            repeated += 1
        elif line.strip():
            lines.add(line)
    by_byte = np.bincount(np.frombuffer(data, dtype="u1"), minlength=256)
    classes = np.bincount(_CLASS, weights=by_byte, minlength=len(CLASSES) + 1)[: len(CLASSES)]
    common = [0] * len(WORDS)
    for w in words:
        if (len(w) <= _LONGEST or w[0] in _MARKS or w[-1] in _MARKS) and (k := _PLACE.get(w.lower().strip(_MARKS))) is not None:
            common[k] += 1
    bare = data.translate(None, _WS + _INNER)
    return len(words), len(bare), len(data) - len(data.translate(None, _SYMBOLS)), repeated, repeated_words(words), classes.astype("i8").tolist(), common


_NAMES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _measured(batches):
    for batch in batches:
        found = [measures(t.as_py()) for t in batch.column("text")]
        columns = list(zip(*found)) or [[] for _ in range(7)]
        own = [sum(m[6][k] for k in _OWN.get(lang, ())) for lang, m in zip(batch.column("lang").to_pylist(), found)]
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(c) for c in ("key", "lang")), *(pa.array(list(c), pa.int64()) for c in columns[:5]), *(pa.array(list(c), pa.list_(pa.int64())) for c in columns[5:]), pa.array(own, pa.int64())],
            ["key", "lang", *_NAMES, "classes", "common", "own"],
        )


def _distance(p: str, q: str) -> Column:
    """Jensen-Shannon distance of two arrays of shares, to base 2: 0 if alike, 1 if nothing is shared."""
    half = "if(x = 0, 0D, x * log2(2 * x / (x + y)) / 2) + if(y = 0, 0D, y * log2(2 * y / (x + y)) / 2)"
    return F.expr(f"sqrt(greatest(0D, aggregate(zip_with({p}, {q}, (x, y) -> {half}), 0D, (a, x) -> a + x)))")


def _shares(counts: str, total: str) -> str:
    """SQL: the shares of an array of counts, and of what remains of total."""
    of = f"cast(greatest({total}, 1) as double)"
    return f"concat(transform({counts}, x -> x / {of}), array(({total} - aggregate({counts}, 0L, (a, x) -> a + x)) / {of}))"


def quality_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", most_class_distance: float = 0.12, class_slack: float = 0.5, most_word_distance: float = 0.05, word_slack: float = 4.2, most_common_distance: float = 0.06, common_slack: float = 1.7, least_chars: int = 200, least_words: int = 100, least_common_words: int = 50, key: Column | None = None) -> DataFrame:
    """One row per input row: id_col, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept,
    class_distance, word_distance, common_distance, _key.

    References come from all documents that pass the base rules, by language; languages without common words of their
    own, and null, share one over all such documents, of classes only. A distance is too large above
    most_class_distance + class_slack / sqrt(characters), from least_chars characters on; for the histogram of common
    words above most_word_distance + word_slack / sqrt(words), from least_words words on; for the language's common
    words against all others above most_common_distance + common_slack / sqrt(words), from least_common_words words on.
    The slacks are what chance alone hardly reaches: twice the expected distance of a histogram of some 23 words, four
    standard deviations of a histogram of two. A document fails if one distance is too large; one that isn't measured is
    null. Null, empty and blank texts have no words and fail the base rules. Repeated rows and null ids are rows like
    others; an empty table gives none. A very long text is counted whole, in space that grows with its words.
    """
    numbered = docs.withColumn("_key", row_number() if key is None else key)
    own = F.when(F.col(lang_col).isin(*COMMON), F.col(lang_col)).otherwise("")
    pairs = numbered.select(F.struct(F.col(id_col).alias("id"), F.col("_key").alias("key")).alias("key"), own.alias("lang"), whole_text(text_col).cast("binary").alias("text"))
    kind = pairs.schema["key"].dataType.simpleString()
    schema = f"key {kind}, lang string, {', '.join(f'{n} long' for n in _NAMES)}, classes array<bigint>, common array<bigint>, own long"
    found = written(map_batches(pairs, _measured, schema).withColumn("base_failed", F.expr(f"n_words < {LEAST_WORDS} or 100 * n_repeat_words > {MOST_REPEATED} * n_words")), "quality")
    found = found.withColumn("chars", F.expr("aggregate(classes, 0L, (a, x) -> a + x)"))
    found = found.withColumns({"class_shares": F.expr("slice(" + _shares("classes", "chars") + f", 1, {len(CLASSES)})"), "word_shares": F.expr(_shares("common", "n_words")), "own_shares": F.expr(_shares("array(own)", "n_words"))})

    # A row for each language that COMMON lists and one for all: five at most.
    whole = lambda column, k: F.floor(F.col(column)[k] * UNITS + 0.5).cast("decimal(20,0)")
    average = lambda column, n: F.array(*(F.sum(whole(column, k)).cast("double") / F.count(F.lit(1)) / UNITS for k in range(n)))
    sound = found.where("not base_failed")
    refs = sound.groupBy("lang").agg(average("class_shares", len(CLASSES)).alias("class_ref"), average("word_shares", len(WORDS) + 1).alias("word_ref"), average("own_shares", 2).alias("own_ref"))
    nothing = F.lit(None).cast("array<double>")
    everything = sound.agg(F.lit("").alias("lang"), average("class_shares", len(CLASSES)).alias("class_ref"), nothing.alias("word_ref"), nothing.alias("own_ref")).where("class_ref[0] is not null")
    refs = written(refs.where("lang <> ''").union(everything), "quality-references")

    judged = found.join(F.broadcast(refs), "lang", "left").withColumns({
        "class_distance": F.when(F.col("chars") >= least_chars, _distance("class_shares", "class_ref")),
        "word_distance": F.when((F.col("n_words") >= least_words) & F.col("word_ref").isNotNull(), _distance("word_shares", "word_ref")),
        "common_distance": F.when((F.col("n_words") >= least_common_words) & F.col("own_ref").isNotNull(), _distance("own_shares", "own_ref")),
    })
    above = lambda x, base, slack, n: F.coalesce(F.col(x) > base + slack / F.sqrt(n), F.lit(False))
    bad = above("class_distance", most_class_distance, class_slack, "chars") | above("word_distance", most_word_distance, word_slack, "n_words") | above("common_distance", most_common_distance, common_slack, "n_words")
    return judged.select(F.col("key.id").alias(id_col), *_NAMES, "base_failed", (~F.col("base_failed") & ~bad).alias("kept"), "class_distance", "word_distance", "common_distance", F.col("key.key").alias("_key"))


def of_quality(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The rows of docs that quality_rules keeps; the columns stay as they are."""
    docs = steady(docs)
    return without_rows(docs, quality_rules(docs, id_col, text_col, lang_col).where("not kept"))
