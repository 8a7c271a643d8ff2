"""One-vs-rest similarity over profile vectors, all listeners' nearest, and nearest personas.

The target's vector is fetched with a scalar subquery: a single value with
a proven size (one row, selected by a unique key -- Spark raises if the key
matched more than one row), embedded in the plan and compared with every
other row in the scan's own tasks.  No join, no pairs: the work is one
pass over the profiles, split across as many tasks as the table has.

Many targets at once (``similar_users_of``) are compared in blocks: a cell
is one block of targets and one block of profiles, multiplied by NumPy tile
by tile, which passes on its best few rows for each target.
"""
from __future__ import annotations

import math
from decimal import ROUND_HALF_UP, Decimal

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from sonora.fixed_values import PERSONAS, SIMILAR_USERS_TOP_N
from sonora.functions.mood import largest
from sonora.functions.vectors import as_doubles, dot, norm, percent, percent_of_rounded


def default_target(profiles: DataFrame, key: str = "username") -> Column:
    """The first key in sort order -- a data-derived default target."""
    return profiles.agg(F.min(key)).scalar()


def similarity_to(profiles: DataFrame, target: Column, key: str = "username",
                  vector: str = "embedding") -> DataFrame:
    """Every other row with its unrounded cosine to the target."""
    # The target vector and its norm are computed once, in the subquery, and
    # attached as a column: subqueries may not appear inside the higher-order
    # functions that compute the cosine.  Each step is a column of its own, so
    # no interpreted lambda runs twice.
    me = profiles.filter(F.col(key) == target).select(as_doubles(vector).alias("v"))
    me = me.select(F.struct("v", norm("v").alias("n"))).scalar()
    rows = (profiles.filter(F.col(key) != target)
            .withColumn("_target", me)
            .withColumn("_v", as_doubles(vector))
            .withColumn("_dot", dot("_v", "_target.v"))
            .withColumn("_norms", norm("_v") * F.col("_target.n")))
    cos = F.when(F.col("_norms") > 0, F.col("_dot") / F.col("_norms")).otherwise(F.lit(0.0))
    return rows.withColumn("_cos", cos).drop("_target", "_v", "_dot", "_norms")


def cosine_to_target(vectors: DataFrame, target: Column, key: str, vector: str) -> DataFrame:
    """Rounded cosine similarity (4 decimals) of each other row to the target."""
    sim = similarity_to(vectors, target, key, vector)
    return sim.select(key, F.round(F.col("_cos"), 4).alias("similarity"),
                      *[c for c in vectors.columns if c not in (key, vector)])


def similar_users(profiles: DataFrame, target: Column, top_n: int = SIMILAR_USERS_TOP_N,
                  key: str = "username") -> DataFrame:
    """Top ``top_n`` most similar others: similarity = round(round(cos,4)*100,1),
    ties by name.  ``orderBy().limit()`` keeps top_n per task before merging."""
    sim = similarity_to(profiles, target, key)
    return (sim.select(
                F.col(key).alias("username"),
                percent_of_rounded(F.round(F.col("_cos"), 4)).alias("similarity"),
                "top_mood", "avg_energy", "avg_valence", "days_active")
            .orderBy(F.col("similarity").desc(), F.col("username").asc())
            .limit(top_n))


def match_list(profiles: DataFrame, target: Column, key: str = "username") -> DataFrame:
    """All others: similarity = round(cos*100, 1) of the unrounded cosine,
    avg_energy rounded to 2; consumers order by (similarity desc, name)."""
    sim = similarity_to(profiles, target, key)
    return sim.select(
        F.col(key).alias("username"),
        percent(F.col("_cos")).alias("similarity"),
        "top_mood",
        F.round(F.col("avg_energy").cast("double"), 2).alias("avg_energy"),
        "days_active")


#: Expected rows in a block of targets or of profiles: a cell holds two blocks and one tile of their products.
BLOCK_ROWS = 32768
#: Targets and profiles of one tile, whose products lie in the cache, and the profiles of a target's first tile.
TILE = (512, 1024)
FIRST_TILE = 512
#: Squared norms between these neither overflow nor lose digits in the products of two vectors.
PLAIN_SQUARES = (1e-200, 1e200)
_NONE = -2 ** 62  # tenths of a place not yet taken


def _rounded4(cos: np.ndarray) -> np.ndarray:
    """Cosines as counts of 1e-4, rounded half up by their decimal form as ``F.round`` does."""
    scaled = cos * 10000.0
    n = np.floor(np.abs(scaled) + 0.5)
    ties = np.abs(np.abs(scaled) - np.floor(np.abs(scaled)) - 0.5) < 1e-6
    values, which = np.unique(np.abs(cos[ties]), return_inverse=True)
    n[ties] = np.array([int((Decimal(repr(float(v))) * 10000).quantize(Decimal(1), ROUND_HALF_UP)) for v in values], float)[which]
    return (np.sign(scaled) * n).astype(np.int64)


def _tenths(cos: np.ndarray) -> np.ndarray:
    """Similarities of cosines, ``round(round(cos,4)*100,1)``, as counts of a tenth."""
    n = _rounded4(cos)
    return np.sign(n) * ((np.abs(n) + 5) // 10)


def _least_cosine(tenths: np.ndarray, margin: float) -> np.ndarray:
    """No product below this one, if right to ``margin``, has a similarity of ``tenths`` or more."""
    return ((10.0 * tenths - 5.5) / 10000.0 - margin).astype(np.float32)


def _matrix(vectors: pd.Series) -> np.ndarray:
    """One row for each vector; a missing vector, or one with a missing component, is all zeros."""
    given = np.array([v is not None for v in vectors], bool)
    there = [v for v in vectors if v is not None]
    widths = {len(v) for v in there}
    if len(widths) > 1:
        raise ValueError(f"vectors of {min(widths)} and of {max(widths)} dimensions")
    out = np.zeros((len(vectors), max(widths, default=0)))
    if there:
        out[given] = np.concatenate(there).astype(float).reshape(len(there), out.shape[1])
    out[np.isnan(out).any(1)] = 0.0
    return out


class _Vectors:
    """A block's vectors by dimension, their norms, and their directions as 32-bit numbers.

    A direction is zeros for a zero vector and NaN where the squared norm is not plain: no bound holds there.
    """

    def __init__(self, rows: np.ndarray) -> None:
        squares = (rows * rows).cumsum(1)[:, -1] if rows.shape[1] else np.zeros(len(rows))
        self.norms = np.sqrt(squares)
        self.odd = (squares != 0) & ~((squares > PLAIN_SQUARES[0]) & (squares < PLAIN_SQUARES[1]))
        self.directions = np.divide(rows, self.norms[:, None], out=np.zeros_like(rows), where=(self.norms > 0)[:, None]).astype(np.float32)
        self.directions[self.odd] = np.nan
        self.by_dim = np.ascontiguousarray(rows.T)


def _pair_tenths(a: _Vectors, i: np.ndarray, b: _Vectors, j: np.ndarray) -> np.ndarray:
    """Similarities of the pairs (i, j); products are added up dimension by dimension, in the order in which ``dot`` adds them."""
    dots = np.zeros(len(i))
    for x, y in zip(a.by_dim, b.by_dim):
        dots += x[i] * y[j]
    norms = a.norms[i] * b.norms[j]
    return _tenths(np.divide(dots, norms, out=np.zeros_like(dots), where=norms > 0))


def _best_of_tile(a: _Vectors, asked: np.ndarray, mine: np.ndarray, b: _Vectors, theirs: np.ndarray, top_n: int) -> tuple[np.ndarray, np.ndarray]:
    """For the targets ``asked`` of one tile, the places of their best profiles and the similarities, ``top_n`` each.

    Profiles lie in the order of their names and are met in that order, so a later one is better only with a greater
    similarity than the last one held.  32-bit products, right to ``margin``, pass over pairs that cannot have it;
    the others are computed as ``similar_users`` computes them.  A target that holds only similarities of 100 is done.
    """
    margin = (len(b.by_dim) + 8) * 2.0 ** -23
    best, at = np.full((len(asked), top_n), _NONE), np.full((len(asked), top_n), -1)

    def take(who: np.ndarray, products: np.ndarray, least: np.ndarray, start: int) -> None:
        i, j = np.nonzero(~(products < least[:, None]))  # NaN is not below either
        i, j = who[i], j + start
        n = _pair_tenths(a, asked[i], b, j)
        new = (mine[asked[i]] != theirs[j]) & (n > best[i, -1])
        touched = np.unique(i[new])
        who = np.concatenate([np.repeat(touched, top_n), i[new]])
        n, j = np.concatenate([best[touched].ravel(), n[new]]), np.concatenate([at[touched].ravel(), j[new]])
        order = np.lexsort((j, -n, who))
        who, n, j = who[order], n[order], j[order]
        held = np.arange(len(who)) - np.searchsorted(who, who) < top_n
        best[touched], at[touched] = n[held].reshape(-1, top_n), j[held].reshape(-1, top_n)

    live, directions = np.arange(len(asked)), a.directions[asked]
    turned, room = b.directions.T, np.empty(TILE[0] * TILE[1], np.float32)
    end = min(max(FIRST_TILE, 8 * top_n), len(theirs))
    products = directions @ turned[:, :end]
    sure = np.where((mine[asked][:, None] == theirs[:end]) | np.isnan(products), np.float32(-2), products).astype(float) - margin
    seed = np.partition(sure, end - top_n, axis=1)[:, end - top_n] if end >= top_n else np.full(len(asked), -2.0)
    take(live, products, _least_cosine(_tenths(seed), margin), 0)
    odd = bool(b.odd.any()) or bool(a.odd[asked].any())
    while end < len(theirs):
        start, end = end, min(end + TILE[1], len(theirs))
        least = _least_cosine(best[live, -1] + 1, margin)
        if not odd and (least > 1.0 + margin).any():
            left = least <= 1.0 + margin
            live, least, directions = live[left], least[left], directions[left]
            if not len(live):
                break
        products = np.matmul(directions, turned[:, start:end], out=room[:len(live) * (end - start)].reshape(len(live), -1))
        hit = ~(products.max(1) < least)
        if hit.any():
            take(live[hit], products[hit], least[hit], start)
    return best, at


def _best_of_cell(top_n: int):
    def best(targets: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        """The ``top_n`` most similar rows of one block for each target of another."""
        rows = rows.sort_values("name", ignore_index=True)
        a, b = _matrix(targets["v"]), _matrix(rows["v"])
        if not len(a) or not len(b) or top_n < 1:
            return pd.DataFrame({"target": targets["name"][:0], "username": rows["name"][:0], "tenths": np.zeros(0, np.int64)})
        if a.shape[1] != b.shape[1] and targets["v"].isna().all():  # no vector in a whole block
            a = np.zeros((len(a), b.shape[1]))
        if a.shape[1] != b.shape[1] and rows["v"].isna().all():
            b = np.zeros((len(b), a.shape[1]))
        if a.shape[1] != b.shape[1]:
            raise ValueError(f"vectors of {a.shape[1]} and of {b.shape[1]} dimensions")
        a, b = _Vectors(a), _Vectors(b)
        names = pd.factorize(pd.concat([targets["name"], rows["name"]]))[0]
        mine, theirs = names[:len(targets)], names[len(targets):]
        found = []
        for start in range(0, len(mine), TILE[0]):
            asked = np.arange(start, min(start + TILE[0], len(mine)))
            n, at = _best_of_tile(a, asked, mine, b, theirs, top_n)
            who, place = np.nonzero(n != _NONE)
            found.append((asked[who], at[who, place], n[who, place]))
        who, at, n = (np.concatenate(x) for x in zip(*found))
        return pd.DataFrame({"target": targets["name"].to_numpy()[who], "username": rows["name"].to_numpy()[at], "tenths": n})

    return best


def similar_users_of(targets: DataFrame, profiles: DataFrame, top_n: int = SIMILAR_USERS_TOP_N, key: str = "username",
                     vector: str = "embedding", block_rows: int = BLOCK_ROWS) -> DataFrame:
    """For every target row, its ``top_n`` most similar other profiles: target, rank (from 1), username, similarity.

    Exact, and equal to ``similar_users`` run for each target: similarity = round(round(cos,4)*100,1), ties by
    name.  Targets and profiles are dealt to blocks of about ``block_rows`` rows by a hash of the key; every block of
    targets meets every block of profiles in a cell of its own, so no task holds more than two blocks at a time, and
    a cell sends on ``top_n`` rows for each target.  Every pair gets a 32-bit product, only pairs that may be among
    the best are computed in full.  Work grows with targets times profiles, rows shuffled with their sum times the
    blocks of a side.  Keys are unique on either side; rows with a null key take no part.  A missing vector counts as
    zeros (similarity 0); vectors of several lengths are refused.  An empty side gives an empty result.
    """
    def side(df: DataFrame) -> tuple[DataFrame, Column]:
        rows = df.filter(F.col(key).isNotNull()).select(F.col(key).cast("string").alias("name"), as_doubles(vector).alias("v"))
        return rows, F.greatest(F.ceil(df.agg(F.count(F.lit(1))).scalar() / block_rows), F.lit(1)).cast("int")

    (asked, n_asked), (rows, n_rows) = side(targets), side(profiles)
    block = lambda n: F.pmod(F.xxhash64("name"), n).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), n - 1))
    asked = asked.withColumn("t", block(n_asked)).withColumn("r", every(n_rows))
    rows = rows.withColumn("r", block(n_rows)).withColumn("t", every(n_asked))
    cells = (asked.groupBy("t", "r").cogroup(rows.groupBy("t", "r"))
             .applyInPandas(_best_of_cell(top_n), "target string, username string, tenths bigint"))
    place = F.row_number().over(Window.partitionBy("target").orderBy(F.col("tenths").desc(), "username"))
    return (cells.withColumn("rank", place).filter(F.col("rank") <= top_n)
            .select("target", "rank", "username", (F.col("tenths") / 10.0).alias("similarity")))


def fingerprint_card(profiles: DataFrame, target: Column, key: str = "username") -> DataFrame:
    """The target's own summary row (point lookup by key)."""
    return profiles.filter(F.col(key) == target).select(
        "top_mood", "avg_energy", "avg_valence", "total_plays", "days_active")


def nearest_persona(profiles: DataFrame, key: str = "username") -> DataFrame:
    """For each profile, the persona whose centroid is most similar: its name
    and the cosine rounded to 4; equal cosines go to the persona listed first."""
    rows = profiles.withColumn("_v", as_doubles("embedding")).withColumn("_n", norm("_v"))
    for name, centroid in PERSONAS.items():
        c = F.array(*[F.lit(float(x)) for x in centroid])
        size = math.sqrt(sum(float(x) ** 2 for x in centroid))
        rows = rows.withColumn(f"_{name}", F.round(F.when(F.col("_n") > 0, dot("_v", c) / (F.col("_n") * size)).otherwise(0.0), 4))
    found = {name: F.col(f"_{name}") for name in PERSONAS}
    return rows.select(key, largest(found).alias("persona"), F.greatest(*found.values()).alias("similarity"))
