"""Spelling variants: words one edit apart, found by edit-distance rows along sorted word lists.

Words that are one edit apart share what lies before and behind the edit. So each word is sent, for each of two halves, to the
group of words that share the other half; in a group the parts that differ are sorted, and one scan of the list keeps the
banded edit-distance rows (three cells) of every query against the list's current prefix. The next part reuses the rows up to
its longest common prefix with the last one, and a range of parts whose shared prefix is beyond one edit from every query is
skipped. A group with too many words is dealt out again by halves of its part, so no task holds an unbounded group.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import LOWER, Tables, run_hashes, runs, slices, utf8

LEAST_LENGTH, LEAST_COUNT, TIMES = 6, 5, 5
#: One word in so many of a document's is damaged, if asked for.
DAMAGE = 199
#: Groups of more words are split, as long as the differing part has over two characters.
GROUP = 4096
#: Words in groups that a task scans.
ROWS = 40_000
#: Bytes of text that are counted at once, and counts that a task holds before it sends them on.
PIECE_BYTES, HELD = 1 << 20, 1 << 19

# --- the vocabulary -------------------------------------------------------------------------

LETTER = np.zeros(256, bool)
LETTER[65:91] = LETTER[97:123] = LETTER[0xC3] = True
_CRC = np.array([zlib.crc32(bytes([i])) ^ zlib.crc32(b"\0") for i in range(256)], np.uint32)  # of one byte's difference
_shifts: dict[int, np.ndarray] = {}


def _shift(n: int) -> np.ndarray:
    """Four tables of 256: what each byte of a CRC-32 becomes when n more bytes follow; their xor is the whole."""
    if n not in _shifts:
        base, zeros = zlib.crc32(bytes(n), 0), bytes(n)
        _shifts[n] = np.array([[zlib.crc32(zeros, b << (8 * k)) ^ base for b in range(256)] for k in range(4)], np.uint32)
    return _shifts[n]


def crc_after(prefix: np.ndarray, length: np.ndarray, crc: np.ndarray) -> np.ndarray:
    """CRC-32 of a prefix and a word, given both CRCs and the word's length in bytes."""
    out = crc.copy()
    for n in np.unique(length).tolist():
        at, table = np.flatnonzero(length == n), _shift(n)
        p = prefix[at]
        out[at] ^= table[0][p & 255] ^ table[1][p >> 8 & 255] ^ table[2][p >> 16 & 255] ^ table[3][p >> 24]
    return out


def letter_runs(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and code points of the maximal runs of A-Z, a-z and U+00C0 to U+00FF: in UTF-8 the last are 0xC3 and a byte."""
    lead = data == 0xC3
    member = LETTER[data]
    member[1:] |= lead[:-1]
    start, end = runs(member, member, offsets)
    leads = np.append(0, np.cumsum(lead))
    return start, end, end - start - (leads[end] - leads[start])


def _counted(ids: list[int | None], texts: pa.Array, least: int, damage: int | None) -> pa.Table:
    """The runs of at least `least` code points in these texts, lower-cased, with their counts."""
    data, offsets = utf8(texts)
    start, end, size = letter_runs(data, offsets)
    long = size >= least
    start, end, size = start[long], end[long], size[long]
    data = LOWER[data]
    _, first, which = np.unique(run_hashes(data, start, end), return_index=True, return_inverse=True)
    count = np.bincount(which, minlength=len(first))
    raw = data.tobytes()
    word = [raw[a:b] for a, b in zip(start[first].tolist(), end[first].tolist(), strict=True)]
    names, counts = word, count
    if damage:
        row = np.searchsorted(offsets, start, "right") - 1
        prefix = np.array([zlib.crc32(f"{'' if i is None else i}:".encode()) for i in ids], np.uint32)
        own = np.fromiter(map(zlib.crc32, word), np.uint32, len(word))
        crc = crc_after(prefix[row], end - start, own[which])
        hit = np.flatnonzero(crc % damage == 0)
        count -= np.bincount(which[hit], minlength=len(first))
        harmed: dict[bytes, int] = {}
        for w, at, n in zip(which[hit].tolist(), crc[hit].tolist(), size[hit].tolist(), strict=True):
            if n > least:
                text = word[w].decode()
                text = (text[: at % n] + text[at % n + 1 :]).encode()
                harmed[text] = harmed.get(text, 0) + 1
        names, counts = word + list(harmed), np.append(count, np.fromiter(harmed.values(), np.int64, len(harmed)))
    table = pa.table([pa.array(names, pa.binary()).cast(pa.string()), pa.array(counts, pa.int64())], names=["word", "n"])
    return table.filter(pc.greater(table["n"], 0))


def _summed(tables: list[pa.Table]) -> pa.Table:
    return pa.concat_tables(tables).group_by("word").aggregate([("n", "sum")]).rename_columns(["word", "n"])


def vocabulary(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT, damage: int | None = None) -> DataFrame:
    """word, n: the letter runs of all whole texts, A-Z lower-cased, with at least so many code points and occurrences.

    With `damage`, a run of a document loses the code point h % length if h, the CRC-32 of "<id>:<run>", is divisible by it; a
    null id is empty there. Null and empty texts have no runs; repeated rows count again. Counts are summed up within a task
    first, so that a frequent word is sent once a task.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0
        for piece in slices(batches, most=PIECE_BYTES):
            held.append(_counted(piece.column("doc_id").to_pylist(), piece.column("text"), least_length, damage))
            rows += held[-1].num_rows
            if rows > HELD:
                held = [_summed(held)]
                rows = held[0].num_rows
                if rows > HELD // 2:
                    yield from held[0].combine_chunks().to_batches()
                    held, rows = [], 0
        if held:
            yield from _summed(held).combine_chunks().to_batches()

    docs = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return docs.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count)


# --- near words -----------------------------------------------------------------------------


def _codes(parts: list[str], width: int) -> np.ndarray:
    """The code points of each part in a row, 0 behind its end."""
    return np.array(parts, dtype=f"<U{width}").view(np.uint32).reshape(len(parts), width) if parts else np.zeros((0, width), np.uint32)


def near_in_list(parts: list[str], guests: list[str], visit) -> int:
    """visit(i, near) for each part, in order, with the indexes into parts + guests that are one edit away from it.

    parts are sorted, distinct and equally long, guests one character longer. Returns the number of prefixes that rows were
    computed for.
    """
    size = len(parts[0])
    queries = _codes(parts + guests, size + 2)
    own = np.arange(len(queries))
    longer = own >= len(parts)
    # Row p has the distances of the list's prefix of length p to the queries' prefixes of p-1, p and p+1 characters.
    top = np.empty((len(queries), 3), np.int8)
    top[:] = (3, 0, 1)
    alive: list[tuple[np.ndarray, np.ndarray]] = [(own, top)]  # for each prefix length: the queries within one edit, their rows
    computed, i = 0, 0
    codes = queries[: len(parts), :size]
    same = codes[1:] == codes[:-1]
    common = np.append(0, np.where(same.all(axis=1), size, same.argmin(axis=1))).tolist() if len(parts) > 1 else [0]
    beyond = size + 1  # a prefix of this length is beyond one edit of every query
    for i in range(len(parts)):
        if common[i] >= beyond:
            continue  # in the range that shares such a prefix
        del alive[common[i] + 1 :]
        beyond = size + 1
        for p in range(common[i] + 1, size + 1):
            who, row = alive[-1]
            letter = codes[i, p - 1]
            left = row[:, 0] + (queries[who, p - 2] != letter) if p > 1 else np.full(len(who), 3, np.int8)
            a = np.minimum(left, row[:, 1] + 1)
            b = np.minimum(np.minimum(row[:, 1] + (queries[who, p - 1] != letter), row[:, 2] + 1), a + 1)
            c = np.minimum(row[:, 2] + (queries[who, p] != letter), b + 1)
            new = np.stack([a, b, c], axis=1).astype(np.int8)
            computed += 1
            within = new.min(axis=1) <= 1
            alive.append((who[within], new[within]))
            if not within.any():
                beyond = p
                break
        else:
            who, row = alive[-1]
            near = who[np.where(longer[who], row[:, 2], row[:, 1]) == 1]
            if len(near):
                visit(i, near)
    return computed


def _group(length: int, stop: int, left: str, right: str, role: list[int], part: list[str], count: list[int]) -> list[tuple[str, int, int, str]]:
    """word, near words, and the best of them, with its count, for the words of a group that have any here."""
    order = sorted(range(len(part)), key=lambda i: (role[i], part[i]))
    members = sum(r == 0 for r in role)
    if not members or len(order) == 1:
        return []
    parts, n = [part[i] for i in order], np.array([count[i] for i in order], np.int64)
    found, best = np.zeros(len(order), np.int64), np.full(len(order), -1)
    size = len(parts[0])
    last = stop == length

    def visit(i: int, near: np.ndarray) -> None:
        if not last:  # an insertion behind the part belongs to the group of the next part
            near = near[[q < members or parts[q][:size] != parts[i] for q in near.tolist()]]
            if not len(near):
                return
        found[i] += len(near)
        most = near[n[near] == n[near].max()]
        best[i] = min(most.tolist(), key=parts.__getitem__)
        guests = near[near >= members]
        found[guests] += 1
        better = guests[n[i] > np.where(best[guests] < 0, -1, n[best[guests]])]  # members come in order: of equal ones the first stays
        best[better] = i

    near_in_list(parts[:members], parts[members:], visit)
    return [(left + parts[i] + right, int(found[i]), int(n[best[i]]), left + parts[best[i]] + right) for i in np.flatnonzero(found).tolist()]


KEY = ["length", "start", "stop", "left", "right"]


def _dealt(words: DataFrame, parts: Column) -> DataFrame:
    """words(word, n, size, role) in the groups of the given parts: an array of (start, stop) in a word without its guest's extra character."""
    at = words.withColumn("at", F.explode(parts)).where("at.stop > at.start")
    size = F.col("size") - F.col("role")
    start, stop = F.col("at.start"), F.col("at.stop")
    # fmt: off
    return at.select(
        size.alias("length"), start.alias("start"), stop.alias("stop"),
        F.col("word").substr(F.lit(1), start).alias("left"), F.col("word").substr(stop + F.col("role") + 1, F.col("size")).alias("right"),
        "role", F.col("word").substr(start + 1, stop - start + F.col("role")).alias("part"), "n",
    )
    # fmt: on


def _halves(start: Column, stop: Column) -> Column:
    middle = F.floor((start + stop) / 2).cast("int")
    return F.array(F.struct(start.alias("start"), middle.alias("stop")), F.struct(middle.alias("start"), stop.alias("stop")))


def near_words(words: DataFrame, tables: Tables, group: int = GROUP) -> DataFrame:
    """word, n_near, near_n, near: of each of the distinct words with a near one the number of near words, and the one of largest n."""
    sized = words.select("word", "n", F.length("word").alias("size"))
    roles = sized.withColumn("role", F.explode(F.array(F.lit(0), F.lit(1)))).where(F.col("size") > F.col("role"))
    rows = _dealt(roles, _halves(F.lit(0), F.col("size") - F.col("role")))
    done = []
    while True:
        rows = tables.store(rows, "spelling-groups")
        large = rows.groupBy(*KEY).agg(F.count("*").alias("rows")).where((F.col("rows") > group) & (F.col("stop") - F.col("start") > 2)).drop("rows")
        large = tables.store(large, "spelling-large")
        if large.isEmpty():
            done.append(rows)
            break
        done.append(rows.join(large, KEY, "left_anti"))
        again = rows.join(large, KEY).select(F.concat("left", "part", "right").alias("word"), "n", (F.col("length") + F.col("role")).alias("size"), "role", F.col("start").alias("from"), F.col("stop").alias("to"))
        rows = _dealt(again, _halves(F.col("from"), F.col("to")))
    rows = done[0]
    for more in done[1:]:
        rows = rows.unionByName(more)
    parts = max(int(words.sparkSession.conf.get("spark.sql.shuffle.partitions")), rows.count() // ROWS)  # a row is small, but its scan isn't
    rows = rows.repartition(parts, *KEY).sortWithinPartitions(*KEY)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held, out = None, ([], [], []), []
        for batch in batches:
            keys = list(zip(*(batch.column(c).to_pylist() for c in KEY), strict=True))
            values = zip(*(batch.column(c).to_pylist() for c in ("role", "part", "n")), strict=True)
            for own, row in zip(keys, values, strict=True):
                if own != key:
                    if len(held[0]) > 1:
                        out += _group(key[0], key[2], key[3], key[4], *held)
                    key, held = own, ([], [], [])
                for column, value in zip(held, row, strict=True):
                    column.append(value)
            if len(out) > 1 << 14:
                yield _batch(out)
                out = []
        if len(held[0]) > 1:
            out += _group(key[0], key[2], key[3], key[4], *held)
        if out:
            yield _batch(out)

    found = rows.mapInArrow(run, "word string, n_near long, near_n long, near string")
    best = F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near")))
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("best")).select("word", "n_near", (-F.col("best.less")).alias("near_n"), F.col("best.near").alias("near"))


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    word, found, n, near = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(word, pa.string()), pa.array(found, pa.int64()), pa.array(n, pa.int64()), pa.array(near, pa.string())], names=["word", "n_near", "near_n", "near"])


# --- forms and roots ------------------------------------------------------------------------


def _roots(forms: DataFrame, tables: Tables) -> DataFrame:
    """word, root of words with a form. Each step doubles how far a word sees; counts grow along the way, so it ends."""
    ahead = tables.store(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        further = ahead.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = ahead.join(further, "root", "left")
        if moved.where("next IS NOT NULL").isEmpty():
            return ahead
        ahead = tables.store(moved.select("word", F.coalesce("next", "root").alias("root")), "spelling-roots")


def variants(words: DataFrame, times: int = TIMES, group: int = GROUP) -> DataFrame:
    """word, form, root, n, n_near, form_n of a vocabulary (word, n).

    Two words are near if one inserted, deleted or replaced code point tells them apart. A word's form is its near word of
    largest n, of equal ones the first in code-point order, if its n is at least `times` the word's own; else null. The root
    is where following the forms ends: the word itself without a form. n_near counts the near words. Rows that repeat a word
    are summed up, a null or empty word is left out, and an empty vocabulary gives an empty result. Every word is one row.
    """
    if times <= 1:
        raise ValueError("times must be above 1, or forms could go round in a circle")
    tables = Tables(words.sparkSession)
    words = tables.store(words.where(F.length("word") > 0).groupBy("word").agg(F.sum("n").cast("long").alias("n")), "spelling-words")
    near = near_words(words, tables, group)
    found = words.join(near, "word", "left")
    has = F.col("near_n") >= times * F.col("n")
    found = tables.store(found.select("word", F.when(has, F.col("near")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(has, F.col("near_n")).alias("form_n")), "spelling-forms")
    tables.drop("spelling-groups", "spelling-large")
    roots = _roots(found.where("form IS NOT NULL"), tables)
    return found.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
