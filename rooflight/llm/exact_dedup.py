"""Exact deduplication through a minimal perfect hash over historical digests.

A history keeps, for every distinct digest it has seen, one slot of a minimal perfect hash function
(a cascade of bit arrays; a key's slot is the rank of its bit). The slot holds the full 32-byte
digest and the locator of the best row so far. New digests are looked up, byte-compared with the
slot, and either merged with it (repeats) or grouped among themselves (nonmembers). Histories are
sharded by digest, a shard has a bounded number of digests, and rows are combined per digest before
each shuffle, so a digest shared by a third of the corpus costs one row per task; where rows meet
their group again, the few digests that many rows share are broadcast.

Edge cases: a null text is an empty text; null ids lose every tie; among rows alike in length and
id any one stays, the others are repeats; whole texts are hashed, however long; extra columns are
ignored (kept by ``keep_distinct``); an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rooflight.llm.shared import BLANK, as_row, look_up, written

SHARD_DIGESTS = 65_536
MIN_SHARDS = 64
_GAMMA = 2
_LOCATOR = ["neg_len", "no_id", "doc_id", "row_uid"]
_GROUP = "digest binary, neg_len long, no_id int, doc_id long, row_uid long, n long"


def _mix(keys: np.ndarray, level: int) -> np.ndarray:
    """Finaliser of splitmix64, another one for each level."""
    with np.errstate(over="ignore"):
        z = keys + np.uint64(0x9E3779B97F4A7C15) * np.uint64(level + 1)
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return z ^ (z >> np.uint64(31))


class PerfectHash:
    """Minimal perfect hash of distinct 32-byte digests: 0 to n-1, -1 where a key surely isn't one of them."""

    def __init__(self, digests: np.ndarray):
        keys, left, self.levels, base = _fold(digests), np.arange(len(digests)), [], 0
        self.slot = np.empty(len(digests), np.int64)
        level = 0
        while len(left):
            size = max(64, _GAMMA * len(left))
            at = (_mix(keys[left], level) % np.uint64(size)).astype(np.int64)
            bits = np.bincount(at, minlength=size) == 1
            rank = base + np.cumsum(bits) - bits
            placed = bits[at]
            self.slot[left[placed]] = rank[at[placed]]
            self.levels.append((size, bits, rank))
            base, left, level = base + int(bits.sum()), left[~placed], level + 1
            if level > 200:
                raise ValueError("digests are not distinct")

    def find(self, digests: np.ndarray) -> np.ndarray:
        keys, out = _fold(digests), np.full(len(digests), -1, np.int64)
        left = np.arange(len(digests))
        for level, (size, bits, rank) in enumerate(self.levels):
            at = (_mix(keys[left], level) % np.uint64(size)).astype(np.int64)
            hit = bits[at]
            out[left[hit]] = rank[at[hit]]
            left = left[~hit]
        return out


def _fold(digests: np.ndarray) -> np.ndarray:
    words = np.ascontiguousarray(digests).view(np.uint64).reshape(-1, 4)
    return words[:, 0] ^ _mix(words[:, 1], 7) ^ _mix(words[:, 2], 11) ^ _mix(words[:, 3], 13)


def _digests(column: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(column), np.uint8).reshape(-1, 32)


def digest_rows(docs: DataFrame) -> DataFrame:
    """(row_uid, doc_id, neg_len, no_id, digest): SHA-256 of the text without white space; written, as row_uid must stay."""
    text = F.coalesce("text", F.lit(""))
    return written(
        docs.select(
            F.monotonically_increasing_id().alias("row_uid"),
            "doc_id",
            (-F.length(text)).cast("long").alias("neg_len"),
            F.col("doc_id").isNull().cast("int").alias("no_id"),
            F.unhex(F.sha2(F.regexp_replace(text, BLANK + "+", "").cast("binary"), 256)).alias("digest"),
        ),
        "digests",
    )


def _best(rows: DataFrame) -> DataFrame:
    return rows.groupBy("digest").agg(F.min(F.struct(*_LOCATOR)).alias("w"), F.count("*").alias("n")).select("digest", "w.*", "n")


def _sharded(groups: DataFrame, shards: int) -> DataFrame:
    return groups.withColumn("shard", F.pmod(F.xxhash64("digest"), F.lit(shards)).cast("int"))


def build_history(groups: DataFrame, shards: int) -> DataFrame:
    """One row (shard, digests, locators) per shard of distinct digests, in the order of the slots."""

    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        slot = PerfectHash(d := _digests(pdf.digest)).slot
        order = np.argsort(slot)
        where = pdf[[*_LOCATOR, "n"]].fillna(0).to_numpy(np.int64)
        return pd.DataFrame({"shard": [pdf.shard.iat[0]], "digests": [d[order].tobytes()], "locators": [where[order].tobytes()]})

    return _sharded(groups, shards).groupBy("shard").applyInPandas(build, "shard int, digests binary, locators binary")


def merge_with_history(history: DataFrame, groups: DataFrame, shards: int) -> DataFrame:
    """Look the digests of new groups up in the history; return every group of either, merged."""

    def merge(old: pd.DataFrame, new: pd.DataFrame) -> pd.DataFrame:
        if len(old):
            slots = np.frombuffer(old.digests.iat[0], np.uint8).reshape(-1, 32)
            where = np.frombuffer(old.locators.iat[0], np.int64).reshape(-1, 5).copy()
        else:
            slots, where = np.empty((0, 32), np.uint8), np.empty((0, 5), np.int64)
        fresh = np.empty((0, 5), np.int64)
        looked = np.empty((0, 32), np.uint8)
        if len(new):
            looked, fresh = _digests(new.digest), new[[*_LOCATOR, "n"]].fillna(0).to_numpy(np.int64)
            at = PerfectHash(slots).find(looked) if len(slots) else np.full(len(looked), -1)
            member = at >= 0
            member[member] = (slots[at[member]] == looked[member]).all(axis=1)  # the byte check
            a, b = where[at[member]], fresh[member]
            differs = a[:, :4] != b[:, :4]
            first = differs.argmax(axis=1)
            rows = np.arange(len(a))
            better = differs.any(axis=1) & (b[rows, first] < a[rows, first])
            merged = np.where(better[:, None], b, a)
            merged[:, 4] = a[:, 4] + b[:, 4]
            where[at[member]] = merged
            looked, fresh = looked[~member], fresh[~member]
        all_where = np.concatenate([where, fresh])
        out = pd.DataFrame(all_where, columns=[*_LOCATOR, "n"])
        out["doc_id"] = out.doc_id.astype("Int64").mask(out.no_id == 1)
        out.insert(0, "digest", [x.tobytes() for x in slots] + [x.tobytes() for x in looked])
        return out

    return history.groupBy("shard").cogroup(_sharded(groups, shards).groupBy("shard")).applyInPandas(merge, _GROUP)


def exact_dedup(docs: DataFrame, historical=None) -> tuple[DataFrame, DataFrame]:
    """(rows, groups) of ``docs``, as written tables.

    rows: see :func:`digest_rows`. groups: digest, the locator of the row that stays, n.
    ``historical`` is a condition on the columns of rows that tells which of them came first and so
    make up the history; by default those whose id hashes to an even number. The result does not
    depend on it.
    """
    rows = digest_rows(docs)
    past = F.pmod(F.xxhash64("doc_id"), F.lit(2)) == 0 if historical is None else historical
    shards = max(MIN_SHARDS, -(-rows.count() // SHARD_DIGESTS))
    history = written(build_history(_best(rows.where(past)), shards), "history")
    return rows, written(merge_with_history(history, _best(rows.where(~past)), shards), "groups")


def dedup_report(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256."""
    rows, groups = exact_dedup(docs)
    shared = groups.where("n > 1").select(
        "digest", "n", F.col("doc_id").alias("best_id"), F.col("row_uid").alias("best_uid"), F.col("n").alias("size")
    )
    alone = F.col("size").isNull()
    return look_up(rows, shared, "digest", rows.count(), "left").select(
        "doc_id",
        F.when(alone, F.col("doc_id")).otherwise(F.col("best_id")).alias("keep_id"),
        F.coalesce("size", F.lit(1)).cast("long").alias("group_size"),
        (alone | (F.col("row_uid") == F.col("best_uid"))).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def keep_distinct(docs: DataFrame) -> DataFrame:
    """``docs`` without the rows that repeat an earlier text; columns unchanged."""
    rows, groups = exact_dedup(docs)
    shared = groups.where("n > 1").select("digest", "n", F.col("row_uid").alias("best_uid"))
    gone = look_up(rows, shared, "digest", rows.count()).where("row_uid <> best_uid").groupBy("doc_id").agg(F.count("*").alias("n_gone"))
    left = rows.groupBy("doc_id").agg(F.count("*").alias("n_rows")).where("n_rows > 1")
    if left.isEmpty():
        return docs.join(gone.select("doc_id"), docs["doc_id"].eqNullSafe(gone["doc_id"]), "left_anti")
    return _keep_repeated_ids(docs, rows.count(), groups)


def _keep_repeated_ids(docs: DataFrame, total: int, groups: DataFrame) -> DataFrame:
    """As ids repeat, the text's digest and length tell rows of one id apart; of equal ones one stays."""
    text = F.coalesce("text", F.lit(""))
    best = groups.select("digest", "n", F.col("doc_id").alias("best_id"), F.col("neg_len").alias("best_len"))
    tagged = docs.select(
        as_row(docs),
        F.col("doc_id").alias("own_id"),
        (-F.length(text)).cast("long").alias("own_len"),
        F.unhex(F.sha2(F.regexp_replace(text, BLANK + "+", "").cast("binary"), 256)).alias("digest"),
    )
    kept = look_up(tagged, best, "digest", total).where(F.col("own_id").eqNullSafe(F.col("best_id")) & (F.col("own_len") == F.col("best_len")))
    return kept.groupBy("digest", "own_id", "own_len").agg(F.first("row").alias("row")).select("row.*")
