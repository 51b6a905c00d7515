"""Spelling variants by bidirectional FM-index search schemes.

Two words are near if one inserted, deleted or replaced code point turns one into the other. By the pigeonhole principle a near
word shares the first or the second half of a word exactly, so there are two schemes: match the first half exactly and extend to the
right with one error, or match the second half and extend to the left. The second is the first one on reversed words.

The vocabulary is range-partitioned by word (and again by reversed word) into blocks. All words that begin with a given half are
then in one block, or in neighbouring ones where it lies on a boundary, and each word asks just those. A block's words, with a
delimiter around each, are indexed in both directions: suffix ranks from prefix doubling, and rank tables over both Burrows-Wheeler
transforms. A half is matched from its end to its beginning and the delimiter, with the interval of the other direction kept in
step; from there the other half is matched onwards, and at each place the interval branches by one replaced, inserted or deleted
symbol and goes on exactly. Branches are arrays, all words of a batch in step. Edits that give the same word inside a run of
equal symbols are made at one place only, and the second scheme leaves out words that share the first half, so each near word is
found once. A block sends back, for each word that asked, the number of near words and the best of them.

A task holds one block of about `block` words, and as many more words that ask it; where a half is so common that more ask, they are
dealt to several tasks which index the block each. The memory of an index is the block's length times about three bytes for each
distinct symbol, so alphabets of some hundred symbols are meant.

Edge cases: null and empty texts have no words; words of any length are searched whole; a word without near words has
n_near 0 and no form; equal words are counted together; null ids count as empty text where ids matter; other columns are not read;
empty tables give an empty result.
"""

from __future__ import annotations

import bisect
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import LOWER, cut, discard, durable, pieces, word_spans

BLOCK = 50_000
"""Words of an index."""
CHUNK = 4096
"""Words searched in step."""


# ---- words of texts ----

def _crc_tables(longest: int) -> np.ndarray:
    """[n, k, v]: what n further zero bytes make of the crc register v << 8k."""
    byte = np.arange(256, dtype=np.uint32)
    table = byte.copy()
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(0xEDB88320), table >> 1)
    at = np.stack([byte << np.uint32(8 * k) for k in range(4)])
    out = [at]
    for _ in range(longest):
        at = (at >> np.uint32(8)) ^ table[at & 255]
        out.append(at)
    return np.stack(out)


def crc_after(head: np.ndarray, tail: np.ndarray, lens: np.ndarray, tables: np.ndarray) -> np.ndarray:
    """crc32 of head and tail in a row, from the crc32 of each and the tail's length, which the tables must reach."""
    return np.bitwise_xor.reduce([tables[lens, k, (head >> np.uint32(8 * k)) & np.uint32(255)] for k in range(4)]) ^ tail


LATIN = np.array([True, False])


def letter_runs(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, code points, runs before each row) of the maximal runs of ASCII letters and U+00C0 to U+00FF in UTF-8 bytes."""
    lead = data == 0xC3
    letter = ((data | 32) >= 97) & ((data | 32) <= 122) & (data < 128) | lead
    letter[1:] |= lead[:-1]
    start, end, first = word_spans(letter.view(np.uint8), offsets, LATIN)
    leads = np.concatenate(([0], np.cumsum(lead)))
    return start, end, end - start - (leads[end] - leads[start]), first


def run_counts(docs: DataFrame, least: int = 7, drop: int = 31) -> DataFrame:
    """(word, n): words of at least `least` code points in the texts of docs (doc_id, text), A-Z lower-cased, and how often they occur.

    Where `drop` divides the crc32 h of `<doc_id>:<run>`, the run loses its code point number h modulo its length; 0 leaves runs alone."""
    longest = 64

    def run(batches):
        tables = _crc_tables(longest)
        for batch in batches:
            ids = [str(x if x is not None else "") for x in batch.column(0).to_pylist()]
            for lo, hi, data, offsets in pieces(batch.column(1), 4 << 20):
                start, end, points, first = letter_runs(data, offsets)
                keep = points >= least
                row = np.repeat(np.arange(lo, hi), np.diff(first))[keep]
                start, end, points = start[keep], end[keep], points[keep]
                coded = cut(LOWER[data], start, end).dictionary_encode()
                code, words = coded.indices.to_numpy(), coded.dictionary.to_pylist()
                gone: dict[str, int] = {}
                if drop and len(code):
                    tail = np.array([zlib.crc32(w.encode()) for w in words], np.uint32)[code]
                    head = np.zeros(hi, np.uint32)
                    head[lo:] = [zlib.crc32(f"{x}:".encode()) for x in ids[lo:hi]]
                    size = end - start
                    h = crc_after(head[row], tail, np.minimum(size, longest), tables)
                    for i in np.flatnonzero(size > longest):
                        h[i] = zlib.crc32(f"{ids[row[i]]}:{words[code[i]]}".encode())
                    hit = h % np.uint32(drop) == 0
                    for c, place, n in zip(code[hit].tolist(), (h[hit] % points[hit].astype(np.uint32)).tolist(), points[hit].tolist(), strict=True):
                        if n > least:
                            w = words[c][:place] + words[c][place + 1:]
                            gone[w] = gone.get(w, 0) + 1
                    code = code[~hit]
                n = np.bincount(code, minlength=len(words))
                yield pa.RecordBatch.from_arrays([pa.concat_arrays([coded.dictionary.cast(pa.string()), pa.array(list(gone), pa.string())]), pa.array(np.concatenate([n, np.fromiter(gone.values(), np.int64, len(gone))]), pa.int64())], ["word", "n"])

    found = docs.select(F.col("doc_id").cast("string").alias("doc_id"), "text").mapInArrow(run, "word string, n long")
    return found.where("n > 0").groupBy("word").agg(F.sum("n").alias("n"))


# ---- index ----

def suffix_ranks(text: np.ndarray, symbols: int) -> np.ndarray:
    """Positions of the suffixes of text in order, by prefix doubling; its last symbol must be 0 and nowhere else."""
    n = len(text)
    bits = max(1, int(symbols - 1).bit_length())
    k = 63 // bits
    wide = np.concatenate([text.astype(np.int64), np.zeros(k, np.int64)])
    key = np.zeros(n, np.int64)
    for j in range(k):
        key = (key << bits) | wide[j: j + n]
    while True:
        order = np.argsort(key)
        step = np.concatenate(([0], np.cumsum(key[order][1:] != key[order][:-1])))
        if step[-1] == n - 1:
            return order
        rank = np.empty(n, np.int64)
        rank[order] = step
        key = rank * (n + 1)
        key[: n - k] += rank[k:] + 1
        k *= 2


class Ranks:
    """Rank queries over the Burrows-Wheeler transform of a text of codes 0 to symbols - 1; code `symbols` occurs nowhere."""

    def __init__(self, text: np.ndarray, symbols: int):
        self.suffix = suffix_ranks(text, symbols)
        last = text[self.suffix - 1]
        n, wide = len(text), symbols + 1
        words = n // 64 + 1
        bits = np.zeros((words, wide), np.uint64)
        at = np.arange(n)
        np.bitwise_or.at(bits, (at >> 6, last), np.uint64(1) << (at & 63).astype(np.uint64))
        self.bits = bits
        self.before = np.zeros((words, wide), np.int64)
        self.before[1:] = np.cumsum(np.bitwise_count(bits[:-1]), 0, dtype=np.int64)
        self.first = np.concatenate(([0], np.cumsum(np.bincount(text, minlength=symbols))))

    def all(self, i: np.ndarray) -> np.ndarray:
        """[query, symbol]: how often each symbol occurs before place i."""
        w = i >> 6
        return self.before[w] + np.bitwise_count(self.bits[w] & ((np.uint64(1) << (i & 63).astype(np.uint64)) - np.uint64(1))[:, None])

    def one(self, c: np.ndarray, i: np.ndarray) -> np.ndarray:
        w = i >> 6
        return self.before[w, c] + np.bitwise_count(self.bits[w, c] & ((np.uint64(1) << (i & 63).astype(np.uint64)) - np.uint64(1)))


class Index:
    """Both directions over words with a delimiter (code 1) around each; letters have codes from 2."""

    def __init__(self, words: list[str]):
        letters = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
        lens = np.fromiter(map(len, words), np.int64, len(words))
        self.alphabet = np.unique(letters)
        self.symbols = len(self.alphabet) + 2
        text = np.ones(len(letters) + len(words) + 2, np.int64)
        text[-1] = 0
        text[np.arange(len(letters)) + np.repeat(np.arange(len(words)), lens) + 1] = np.searchsorted(self.alphabet, letters) + 2
        self.forward = Ranks(text, self.symbols)
        self.backward = Ranks(np.append(text[-2::-1], 0), self.symbols)
        self.delimiters = np.cumsum(text == 1)

    def codes(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(codes of each word and its end delimiter, where each begins); letters that no word has get the code that occurs nowhere."""
        letters = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
        lens = np.fromiter(map(len, words), np.int64, len(words))
        out = np.ones(len(letters) + len(words), np.int64)
        at = np.minimum(np.searchsorted(self.alphabet, letters), max(0, len(self.alphabet) - 1))
        known = self.alphabet[at] == letters if len(self.alphabet) else np.zeros(len(letters), bool)
        out[np.arange(len(letters)) + np.repeat(np.arange(len(words)), lens)] = np.where(known, at + 2, self.symbols)
        return out, np.concatenate(([0], np.cumsum(lens + 1)))

    def word_at(self, rank: np.ndarray) -> np.ndarray:
        """The word whose end delimiter begins the backward suffix of this rank."""
        return self.delimiters[len(self.delimiters) - 2 - self.backward.suffix[rank]] - 2

    def half(self, codes: np.ndarray, begin: np.ndarray, half: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Backward intervals (low, high) of delimiter and first half: matched to the left in the forward index, from the half's end, while
        the backward interval narrows in step."""
        f = self.forward
        n = len(begin)
        low, size, other = np.zeros(n, np.int64), np.full(n, len(self.delimiters)), np.zeros(n, np.int64)
        for t in range(int(half.max(initial=0)) + 1):
            at = np.flatnonzero((half >= t) & (size > 0))
            c = np.where(half[at] > t, codes[begin[at] + half[at] - 1 - t], 1)
            a, b = f.all(low[at]), f.all(low[at] + size[at])
            wide = b - a
            mine = (np.arange(len(at)), c)
            other[at] += np.cumsum(wide, 1)[mine] - wide[mine]
            low[at] = f.first[np.minimum(c, self.symbols)] + a[mine]
            size[at] = wide[mine]
        return other, other + size

    def near(self, words: list[str], half: np.ndarray, second: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(number of the word, number of the indexed word) of each pair one edit apart that shares the first half. second: words are reversed,
        and pairs whose unreversed first halves agree, which the first scheme finds, are left out."""
        for lo in range(0, len(words), CHUNK):
            codes, begin = self.codes(words[lo: lo + CHUNK])
            found = self._near(codes, begin[:-1], np.diff(begin) - 1, half[lo: lo + CHUNK], second)
            for q, t in found:
                yield q + lo, t

    def _near(self, codes, begin, lens, half, second):
        r = self.backward
        run_start = np.arange(len(codes))
        run_start[1:][codes[1:] == codes[:-1]] = 0
        run_start = np.maximum.accumulate(run_start)
        low, high = self.half(codes, begin, half)
        place = begin + half
        end = begin + lens
        q = np.flatnonzero(high > low)
        while len(q):
            p, lo, hi = place[q], low[q], high[q]
            c = codes[p]
            last = p == end[q]
            a, b = r.all(lo), r.all(hi)
            wide = b - a
            here, symbol = np.nonzero(wide[:, 2:])
            symbol += 2
            other = symbol != c[here]
            here, symbol = here[other], symbol[other]
            child = r.first[symbol] + a[here, symbol]
            child_high = child + wide[here, symbol]
            # replaced: the child goes on behind the word's symbol; inserted: before it
            swap = ~last[here]
            add = np.ones(len(here), bool)
            # deleted: the last of a run of equal symbols
            cut_out = np.flatnonzero(~last & (c != codes[np.minimum(p + 1, len(codes) - 1)]))
            if second:
                first = begin[q] + half[q]
                before = np.maximum(p - 1, 0)
                add = (p != first)[here] & ~((codes[before][here] == symbol) & (run_start[before] <= first)[here])
                cut_out = cut_out[run_start[p[cut_out]] >= first[cut_out]]
            yield from self._onwards(codes, end, np.concatenate([q[here[swap]], q[here[add]], q[cut_out]]), np.concatenate([p[here[swap]] + 1, p[here[add]], p[cut_out] + 1]), np.concatenate([child[swap], child[add], lo[cut_out]]), np.concatenate([child_high[swap], child_high[add], hi[cut_out]]))
            mine = (np.arange(len(q)), c)
            low[q] = r.first[np.minimum(c, self.symbols)] + a[mine]
            high[q] = low[q] + wide[mine]
            place[q] += 1
            q = q[(high[q] > low[q]) & ~last]

    def _onwards(self, codes, end, q, p, low, high):
        """Match the rest of the words exactly."""
        r = self.backward
        while len(q):
            c = codes[p]
            low, high = (r.first[np.minimum(c, self.symbols)] + r.one(c, x) for x in (low, high))
            ok = high > low
            done = ok & (p == end[q])
            if done.any():
                yield q[done], self.word_at(low[done])
            q, p, low, high = (x[ok & ~done] for x in (q, p + 1, low, high))


# ---- the vocabulary ----

_ASKED = "word string, n long, n_near long, best_n long, best string"


def _search_block(second: bool):
    def run(group: pa.Table) -> pa.Table:
        keys, n, own, ask = group["key"].to_pylist(), group["n"].to_numpy(), group["own"].to_numpy(), group["ask"].to_numpy()
        words = [keys[i] for i in np.flatnonzero(own)]
        index = Index(words)
        plain = [w[::-1] for w in words] if second else words
        n_own = n[own]
        by_word = np.empty(len(words), np.int64)
        by_word[sorted(range(len(words)), key=plain.__getitem__)] = np.arange(len(words))
        best_first = np.lexsort((by_word, -n_own))
        standing = np.empty(len(words), np.int64)
        standing[best_first] = np.arange(len(words))
        asking = np.flatnonzero(ask)
        asked = [keys[i] for i in asking]
        lens = np.fromiter(map(len, asked), np.int64, len(asked))
        count, best = np.zeros(len(asked), np.int64), np.full(len(asked), len(words))
        for q, t in index.near(asked, lens - lens // 2 if second else lens // 2, second):
            count += np.bincount(q, minlength=len(asked))
            np.minimum.at(best, q, standing[t])
        some = best < len(words)
        t = best_first[np.where(some, best, 0)] if len(words) else best
        return pa.table({
            "word": pa.array([w[::-1] for w in asked] if second else asked, pa.string()), "n": pa.array(n[asking], pa.int64()), "n_near": pa.array(count, pa.int64()),
            "best_n": pa.array(n_own[t] if len(words) else count, pa.int64(), mask=~some), "best": pa.array([plain[i] if s else None for i, s in zip(t.tolist(), some.tolist(), strict=True)], pa.string()),
        })

    return run


def _near_of(words: DataFrame, second: bool, block: int, total: int) -> tuple[DataFrame, DataFrame]:
    """(result of one scheme, written table to discard): how many near words the scheme finds for each word, and the best of them."""
    spark = words.sparkSession
    laid = durable(words.select((F.reverse("word") if second else F.col("word")).alias("key"), "n").repartitionByRange(max(1, -(-total // block)), "key").withColumn("block", F.spark_partition_id()))
    bounds = sorted((r.low, r.block) for r in laid.groupBy("block").agg(F.min("key").alias("low")).collect())  # one for each block of words
    lows, numbers = [x[0] for x in bounds], [x[1] for x in bounds]

    def guests(batches):
        """Words that other blocks must answer as well: those that their half's words reach into."""
        for batch in batches:
            out = []
            for key, n, home in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                half = key[: len(key) - len(key) // 2 if second else len(key) // 2]
                for i in range(max(0, bisect.bisect_right(lows, half) - 1), bisect.bisect_right(lows, half + "\U0010FFFF")):
                    if numbers[i] != home:
                        out.append((numbers[i], key, n))
            yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], pa.int32()), pa.array([x[1] for x in out], pa.string()), pa.array([x[2] for x in out], pa.int64())], ["block", "key", "n"])

    other = laid.select("key", "n", "block").mapInArrow(guests, "block int, key string, n long")
    parts = {r.block: -(-r.n // block) for r in other.groupBy("block").agg(F.count("*").alias("n")).collect()}
    most = F.create_map(*(F.lit(x) for b in numbers for x in (b, max(1, parts.get(b, 1))))) if numbers else F.create_map(F.lit(0), F.lit(1))
    own = laid.select("block", "key", "n", F.explode(F.sequence(F.lit(0), most[F.col("block")] - 1)).alias("part")).select("block", "part", "key", "n", F.lit(True).alias("own"), (F.col("part") == 0).alias("ask"))
    dealt = other.select("block", F.pmod(F.xxhash64("key"), most[F.col("block")]).cast("int").alias("part"), "key", "n", F.lit(False).alias("own"), F.lit(True).alias("ask"))
    tasks = max(sum(max(1, parts.get(b, 1)) for b in numbers), int(spark.conf.get("spark.sql.shuffle.partitions")))
    return own.unionByName(dealt).repartition(tasks, "block", "part").groupBy("block", "part").applyInArrow(_search_block(second), _ASKED), laid


def variant_groups(words: DataFrame, ratio: int = 10, block: int = BLOCK) -> DataFrame:
    """(word, n, n_near, form, form_n, root) for each row of words (word, n), whose words differ.

    n_near counts the words one edit away; form is the one of largest n (ties: the least in code-point order) if its n is at least
    `ratio` times the word's; root follows forms to the last."""
    words = durable(words.select("word", F.col("n").cast("long").alias("n")))
    total = words.count()
    sides = [_near_of(words, second, block, total) for second in (False, True)]
    key = F.struct((-F.col("best_n")).alias("n"), F.col("best").alias("word"))
    merged = sides[0][0].unionByName(sides[1][0]).groupBy("word", "n").agg(F.sum("n_near").alias("n_near"), F.min(F.when(F.col("best").isNotNull(), key)).alias("best"))
    fits = -F.col("best.n") >= F.lit(ratio) * F.col("n")
    found = durable(merged.select("word", "n", "n_near", F.when(fits, F.col("best.word")).alias("form"), F.when(fits, -F.col("best.n")).alias("form_n")))
    discard(words, *(table for _, table in sides))
    # Each form has `ratio` times the occurrences of its word, so chains are short; each round doubles the steps taken.
    links = durable(found.where("form IS NOT NULL").select("word", F.col("form").alias("root")))
    while True:
        onward = links.select(F.col("word").alias("root"), F.col("root").alias("next"))
        longer = durable(links.join(onward, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")))
        discard(links)
        links = longer
        if not longer.where("moved").limit(1).count():
            break
    return found.join(links.select("word", "root"), "word", "left").select("word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root"))
