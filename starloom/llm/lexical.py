"""Ranked lexical search by pipelined term partitioning.

Every text becomes postings (term, place of the document, impact) for the terms that some item has. Terms belong to one of four
successive owners by their weight, rarest first; an owner's postings lie in blocks of up to 4,096 documents, so that no owner
of a common term holds it whole. A bundle of up to 256 items visits, for each block, the four owners in turn by cogroup: it
brings the weights of its terms and a sparse list of accumulators (item, document, score so far), an owner adds
weight x impact in 64-bit integers and passes the bundle on. The last owner, which has the commonest terms and so opens the
most accumulators, sends only each item's best rows of the block to the final selection.

What is exchanged: postings once; accumulators between owners; `top` rows an item and block at the end. Terms are 64-bit hashes of
their lower-cased bytes. Tasks get a bitmap of fixed size of the items' terms, which lets others pass at a small rate (they
meet no weight later), and the owners of terms in over e**-5 of all documents: at most 150 times a document's mean number of
distinct terms. Everything else is joined.

Edge cases: null and empty texts have no terms; a document without terms counts in neither N nor ranks; repeated rows are ranked
each; items with equal or null ids are ranked each under that id; null doc_ids come last among equal scores; an item that
meets no document has no row; empty tables give an empty result; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from starloom.llm.common import Rolling, durable, pieces, word_spans

GAP = np.array([not (48 <= b <= 57 or 65 <= b <= 90 or 97 <= b <= 122 or b >= 128) for b in range(256)])
"""Bytes outside terms; a term is a run of ASCII letters and digits and of anything beyond ASCII."""
OWNERS = (5000, 3500, 2000)
"""Least weights of the owners but the last: terms in under e**-5, e**-3.5, e**-2 of all documents, and the rest."""
PLACE = 12
"""Bits of a document's place in its block."""
SLOT = 8
"""Bits of an item's slot in its bundle."""
BITS = 22
"""The bitmap of the items' terms has 2**BITS bits."""
_POSTINGS = "doc_id long, n long, terms array<long>, tfs array<int>"


def term_counts(column: pa.Array):
    """For runs of rows: (first row, end row, terms of each row with repeats, row of each distinct term, its hash, its count)."""
    for lo, hi, data, offsets in pieces(column):
        start, end, first = word_spans(data, offsets, GAP)
        term = Rolling(data, lower=True).spans(start, end).view(np.int64)
        row = np.repeat(np.arange(hi - lo), np.diff(first))
        order = np.lexsort((term, row))
        term, row = term[order], row[order]
        new = np.ones(len(term), bool)
        new[1:] = (term[1:] != term[:-1]) | (row[1:] != row[:-1])
        at = np.flatnonzero(new)
        yield lo, hi, np.diff(first), row[at], term[at], np.diff(np.append(at, len(term)))


def _lists(values: np.ndarray, row: np.ndarray, rows: int, kind: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.searchsorted(row, np.arange(rows + 1)), pa.int32()), pa.array(values, kind))


def postings(docs: DataFrame, bitmap: np.ndarray | None = None) -> DataFrame:
    """(doc_id, n, terms, tfs) of rows (doc_id, text): all terms, or those whose last BITS bits are in the packed bitmap."""
    def run(batches):
        wanted = None if bitmap is None else np.unpackbits(bitmap).view(bool)
        for batch in batches:
            for lo, hi, n, row, term, tf in term_counts(batch.column(1)):
                if wanted is not None:
                    keep = wanted[term & ((1 << BITS) - 1)]
                    row, term, tf = row[keep], term[keep], tf[keep]
                yield pa.RecordBatch.from_arrays([batch.column(0)[lo:hi], pa.array(n, pa.int64()), _lists(term, row, hi - lo, pa.int64()), _lists(tf, row, hi - lo, pa.int32())], ["doc_id", "n", "terms", "tfs"])

    return docs.mapInArrow(run, _POSTINGS)


def _flat(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """All elements of a list column."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False)


def by_owner(found: DataFrame, common: np.ndarray, owner: np.ndarray, n_docs: int, n_terms: int) -> DataFrame:
    """Postings of each block by owner, with impacts in place of counts. common: sorted hashes of terms that the first owner does not
    have; owner: theirs."""
    stages = range(len(OWNERS) + 1)

    def run(batches):
        for batch in batches:
            block, place = (batch.column(i).to_numpy() for i in (0, 1))
            tf, lens = _flat(batch.column(5)).astype(np.int64), np.diff(batch.column(4).offsets.to_numpy())
            term = _flat(batch.column(4))
            m = np.repeat(25 + 75 * batch.column(3).to_numpy() * n_docs // max(1, n_terms), lens)
            impact = 1_000_000_000 * tf // (1000 * tf + 8 * m)
            at = np.minimum(np.searchsorted(common, term), max(0, len(common) - 1))
            whose = np.where(common[at] == term, owner[at], 0) if len(common) else np.zeros(len(term), np.int64)
            blocks, group = np.unique(block, return_inverse=True)
            of = np.repeat(group, lens)
            where = np.repeat(place, lens)
            docs = np.argsort(group, kind="stable")
            columns = [pa.array(blocks), _lists(place[docs], group[docs], len(blocks), pa.int32()), pa.ListArray.from_arrays(pa.array(np.searchsorted(group[docs], np.arange(len(blocks) + 1)), pa.int32()), batch.column(2).take(pa.array(docs)))]
            for s in stages:
                mine = np.flatnonzero(whose == s)
                mine = mine[np.lexsort((term[mine], of[mine]))]
                columns += [_lists(x[mine], of[mine], len(blocks), kind) for x, kind in ((where, pa.int32()), (term, pa.int64()), (impact, pa.int32()))]
            yield pa.RecordBatch.from_arrays(columns, names=["block", "doc_place", "doc_ids", *(f"{c}_{s}" for s in stages for c in ("place", "term", "impact"))])

    schema = "block long, doc_place array<int>, doc_ids array<long>, " + ", ".join(f"place_{s} array<int>, term_{s} array<long>, impact_{s} array<int>" for s in stages)
    return found.select(F.shiftright("row", PLACE).alias("block"), F.col("row").bitwiseAND((1 << PLACE) - 1).cast("int").alias("place"), "doc_id", "n", "terms", "tfs").mapInArrow(run, schema)


def _owner_step(s: int, top: int):
    """What owner s does with a bundle and its postings of one block."""
    last = s == len(OWNERS)

    def run(key, bundle: pa.Table, own: pa.Table) -> pa.Table:
        if not bundle.num_rows:
            return pa.table({x: pa.array([], kind) for x, kind in (BEST if last else STEP).items()})
        q = bundle["q"].combine_chunks().flatten()
        stage, q_term, slot, weight = (q.field(x).to_numpy(zero_copy_only=False) for x in ("stage", "term", "slot", "weight"))
        score = np.zeros((bundle["items"].combine_chunks().value_lengths()[0].as_py(), 1 << PLACE), np.int64)
        flat = score.reshape(-1)
        flat[_flat(bundle["acc_key"])] = _flat(bundle["acc_score"])
        if own.num_rows:
            place, term, impact = (_flat(own[x]) for x in ("place", "term", "impact"))
            order = np.argsort(term, kind="stable")
            place, term, impact = place[order], term[order], impact[order].astype(np.int64)
            mine = np.flatnonzero(stage == s)
            mine = mine[np.argsort(q_term[mine], kind="stable")]
            for some in np.split(mine, np.flatnonzero(np.diff(q_term[mine])) + 1) if len(mine) else ():
                lo, hi = np.searchsorted(term, q_term[some[0]], "left"), np.searchsorted(term, q_term[some[0]], "right")
                if hi > lo:
                    for i in some:
                        score[slot[i], place[lo:hi]] += weight[i] * impact[lo:hi]
        return best(bundle, own, score) if last else passed_on(bundle, q, stage, flat)

    def passed_on(bundle, q, stage, flat):
        open_ = np.flatnonzero(flat)
        rest = q.take(pa.array(np.flatnonzero(stage > s)))
        one = lambda x: pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x)
        return pa.table({"block": bundle["block"], "bundle": bundle["bundle"], "items": bundle["items"], "q": one(rest), "acc_key": one(pa.array(open_, pa.int32())), "acc_score": one(pa.array(flat[open_], pa.int64()))})

    def best(bundle, own, score):
        items = bundle["items"].combine_chunks().flatten()
        doc, place = own["doc_ids"].combine_chunks().flatten(), _flat(own["doc_place"])
        where = np.full(1 << PLACE, -1)
        where[place] = np.arange(len(place))
        ids, none = doc.fill_null(0).to_numpy(zero_copy_only=False), doc.is_null().to_numpy(zero_copy_only=False)
        item, row, value = [], [], []
        for i, line in enumerate(score):
            at = np.flatnonzero(line)
            if len(at) > top:
                at = at[line[at] >= np.partition(line[at], len(at) - top)[len(at) - top]]
            r = where[at]
            order = np.lexsort((ids[r], none[r], -line[at]))[:top]
            item.append(np.full(len(order), i))
            row.append(r[order])
            value.append(line[at][order])
        item, row = np.concatenate(item), np.concatenate(row)
        number = (bundle["bundle"][0].as_py() << SLOT) + item
        return pa.table({"item": pa.array(number, pa.int64()), "item_id": items.take(pa.array(item)), "doc_id": doc.take(pa.array(row, pa.int64())), "score": pa.array(np.concatenate(value), pa.int64())})

    return run


_Q = pa.struct([("stage", pa.int32()), ("term", pa.int64()), ("slot", pa.int32()), ("weight", pa.int64())])
STEP = {"block": pa.int64(), "bundle": pa.int64(), "items": pa.list_(pa.int64()), "q": pa.list_(_Q), "acc_key": pa.list_(pa.int32()), "acc_score": pa.list_(pa.int64())}
BEST = {"item": pa.int64(), "item_id": pa.int64(), "doc_id": pa.int64(), "score": pa.int64()}
_STEP = "block long, bundle long, items array<long>, q array<struct<stage: int, term: long, slot: int, weight: long>>, acc_key array<int>, acc_score array<long>"


def rank_documents(docs: DataFrame, items: DataFrame, top: int = 10) -> DataFrame:
    """(item_id, rank, doc_id, score): the `top` highest-scoring rows of docs (doc_id, text) for each row of items (item_id, text).

    With N documents that have a term, L terms in all, n in the document, df documents with the term and tf occurrences in this
    one: w = floor(1000 ln((2N + 2) / (2df + 1))), m = 25 + 75nN div L, and the score is the sum over the item's terms, repeats
    included, of w (10**9 tf div (1000 tf + 8m)). Ties go by ascending doc_id."""
    spark = docs.sparkSession
    asked = durable(postings(items.select(F.col("item_id").cast("long").alias("doc_id"), "text")).withColumn("row", F.monotonically_increasing_id()))
    low = (1 << BITS) - 1
    bits = asked.select(F.explode("terms").alias("t")).select(F.col("t").bitwiseAND(low).cast("int").alias("b")).distinct().toPandas().b.to_numpy()  # 2**BITS at most
    bitmap = np.zeros(1 << BITS, np.uint8)
    bitmap[bits] = 1
    bitmap = np.packbits(bitmap)
    found = durable(postings(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), bitmap).withColumn("row", F.monotonically_increasing_id()))
    n_docs, n_terms = found.agg(F.count(F.when(F.col("n") > 0, 1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    df = found.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("df"))
    stage = F.lit(len(OWNERS))
    for s in reversed(range(len(OWNERS))):
        stage = F.when(F.col("w") >= OWNERS[s], s).otherwise(stage)
    q = asked.select("row", F.explode(F.arrays_zip("terms", "tfs")).alias("x")).select("row", F.col("x.terms").alias("term"), F.col("x.tfs").alias("times"))
    weighed = df.join(q.select("term").distinct(), "term", "left_semi").withColumn("w", F.floor(1000 * F.log((2 * F.lit(n_docs) + 2).cast("double") / (2 * F.col("df") + 1))).cast("long")).withColumn("stage", stage)
    weighed = durable(weighed.select("term", "w", "stage"))
    common = weighed.where("stage > 0").toPandas().sort_values("term")  # terms in over e**-5 of the documents
    blocks = durable(by_owner(found, common.term.to_numpy(np.int64), common.stage.to_numpy(np.int64), n_docs, n_terms))

    slots = asked.select(F.shiftright("row", SLOT).alias("bundle"), F.col("row").bitwiseAND((1 << SLOT) - 1).cast("int").alias("slot"), "row", "doc_id")
    held = slots.groupBy("bundle").agg(F.transform(F.sort_array(F.collect_list(F.struct("slot", "doc_id"))), lambda x: x.doc_id).alias("items"))
    terms = q.join(weighed, "term").select(F.shiftright("row", SLOT).alias("bundle"), F.struct("stage", "term", F.col("row").bitwiseAND((1 << SLOT) - 1).cast("int").alias("slot"), (F.col("w") * F.col("times")).alias("weight")).alias("x"))
    bundles = durable(held.join(terms.groupBy("bundle").agg(F.collect_list("x").alias("q")), "bundle"))
    names = [r.bundle for r in bundles.select("bundle").collect()]  # one for 256 items
    if not names:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")

    every = F.explode(F.array(*(F.lit(x).cast("long") for x in names)))
    pipe = blocks.select("block").distinct().withColumn("bundle", every).join(bundles, "bundle").select("block", "bundle", "items", "q", F.array().cast("array<int>").alias("acc_key"), F.array().cast("array<long>").alias("acc_score"))
    for s in range(len(OWNERS) + 1):
        more = ["doc_place", "doc_ids"] if s == len(OWNERS) else []
        own = blocks.select(F.col("block").alias("own_block"), F.col(f"place_{s}").alias("place"), F.col(f"term_{s}").alias("term"), F.col(f"impact_{s}").alias("impact"), *more).withColumn("own_bundle", every)
        pipe = pipe.groupBy("block", "bundle").cogroup(own.groupBy("own_block", "own_bundle")).applyInArrow(_owner_step(s, top), _STEP if s < len(OWNERS) else "item long, item_id long, doc_id long, score long")
    order = W.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return pipe.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top).select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")
