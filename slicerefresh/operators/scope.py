"""Slice scope: a set of values for each slice key.

A slice is ``k1 IN V1 AND k2 IN V2 ...``; the value sets are independent, so
the slice is their cross product, not a list of pairs.  Each set is either

* a literal list  -> an ``IN`` filter that Parquet can push down, or
* a DataFrame / "everything in staging" -> distinct keys, written once to the
  shared folder (the keys of one source in one scan of it), counted, and joined
  with a marker column.  The join is broadcast only when the counted size is
  under ``max_broadcast_keys`` and ``max_broadcast_bytes``; beyond that the plan
  is left to the optimizer: a shuffle join with AQE, for which the keys' file
  statistics allow a runtime Bloom filter on the scan of the table.

Rows whose key is null are never in scope (``coalesce(S, false)``).
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from slicerefresh.functions.predicates import null_safe_true, values_in
from slicerefresh.schema import SLICE_KEYS
from slicerefresh.session import scratch_path

# --- Fixed values: the reference's command-line marker for "all of staging" --
EVERYTHING = "NA"
# ---------------------------------------------------------------------------

DEFAULT_MAX_BROADCAST_KEYS = 1_000_000
DEFAULT_MAX_BROADCAST_BYTES = 64 << 20
DEFAULT_MAX_LITERAL_VALUES = 1_000


@dataclass(frozen=True)
class Scope:
    """Unresolved scope: per key a list, a DataFrame, or ``None`` (= all of staging)."""

    values: Mapping[str, list | DataFrame | None]

    @classmethod
    def of(cls, practices=None, measures=None, keys: tuple[str, str] = SLICE_KEYS) -> Scope:
        return cls({keys[0]: practices, keys[1]: measures})

    @classmethod
    def parse(cls, practices: str, measures: str, keys: tuple[str, str] = SLICE_KEYS) -> Scope:
        """Command-line form: comma lists, or ``NA`` for everything in staging.

        Practice ids are integers; measure ids are compared as text values.
        A value wrapped in single quotes (the snapshot job's already quoted
        measure list) is unwrapped; blanks inside a value are kept.
        """

        def unquote(v: str) -> str:
            v = v.strip()
            return v[1:-1] if len(v) >= 2 and v[0] == v[-1] == "'" else v

        def split(text: str, conv):
            if text.strip() == EVERYTHING:
                return None
            return [conv(unquote(v)) for v in text.split(",") if v.strip()]

        return cls({keys[0]: split(practices, int), keys[1]: split(measures, str)})

    def resolve(
        self,
        sources: DataFrame | Mapping[str, DataFrame] | None = None,
        *,
        max_broadcast_keys: int = DEFAULT_MAX_BROADCAST_KEYS,
        max_broadcast_bytes: int = DEFAULT_MAX_BROADCAST_BYTES,
        max_literal_values: int = DEFAULT_MAX_LITERAL_VALUES,
        allow_empty: bool = False,
    ) -> ResolvedScope:
        """Turn every value set into a list or a counted key frame.

        ``sources`` supplies the frame whose distinct keys stand for ``None``;
        a mapping allows a different source per key (practices from the
        by-practice staging, measures from the by-measure staging).  Keys are
        taken from the raw sources, before any cleaning.  Resolve once and
        reuse the result for every table.
        """
        limits = (max_broadcast_keys, max_broadcast_bytes, max_literal_values)
        parts: dict[str, _KeySet] = {}
        together: list[tuple[DataFrame, list[str]]] = []  # sources and the keys that stand for everything in them
        for key, vals in self.values.items():
            if vals is None:
                src = sources.get(key) if isinstance(sources, Mapping) else sources
                if src is None:
                    raise ValueError(f"scope for {key!r} is 'everything in staging' but no source was given")
                same = [keys for frame, keys in together if frame is src]
                if same:
                    same[0].append(key)
                else:
                    together.append((src, [key]))
            elif isinstance(vals, DataFrame):
                together.append((vals, [key]))
            else:
                lst = list(dict.fromkeys(vals))
                if len(lst) > max_literal_values:
                    spark = SparkSession.getActiveSession()
                    frame = spark.createDataFrame([(v,) for v in lst], [key])
                    parts |= _frame_keys(frame, [key], (*limits[:2], 0))
                else:
                    parts[key] = _KeySet(key, values=lst, size=len([v for v in lst if v is not None]))
        for src, keys in together:
            parts |= _frame_keys(src, keys, limits)
        parts = {key: parts[key] for key in self.values}
        resolved = ResolvedScope(parts)
        if not allow_empty:
            for ks in parts.values():
                if ks.size == 0:
                    raise ValueError(f"scope for {ks.key!r} is empty; pass allow_empty=True to run anyway")
        return resolved


@dataclass
class _KeySet:
    key: str
    values: list | None = None  # literal values, or
    frame: DataFrame | None = None  # distinct key values in column ``key``
    size: int = 0
    broadcast: bool = True
    dtype: T.DataType | None = None  # type of the key in its source, when known

    @property
    def literal(self) -> bool:
        return self.values is not None


def distinct_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Distinct non-null values of several columns in one pass: ``key_no`` and, for
    each column, ``key_0``, ``key_1`` ..., of which the numbered one is set."""
    types = [df.schema[k].dataType for k in keys]

    def value(i: int) -> Column:
        return F.struct(
            F.lit(i).alias("key_no"),
            *[(F.col(k) if i == j else F.lit(None).cast(t)).alias(f"key_{j}") for j, (k, t) in enumerate(zip(keys, types, strict=True))],
        )

    rows = df.select(F.explode(F.array(*[value(i) for i in range(len(keys))])).alias("v")).select("v.*")
    return rows.where(_held(len(keys))).distinct()


def _held(n: int) -> Column:
    held = F.lit(False)
    for j in range(n):
        held = held | F.col(f"key_{j}").isNotNull()
    return held


def _frame_keys(df: DataFrame, keys: list[str], limits: tuple[int, int, int]) -> dict[str, _KeySet]:
    """Distinct non-null values of ``keys`` in ``df``, found in one scan.

    They are written to the shared folder and counted there.  Small sets (at
    most ``max_literal_values``) become literal lists, so that the slice is an
    ``IN`` filter that Parquet can push down.  Larger sets stay distributed, and
    are broadcast only within both limits.
    """
    spark = df.sparkSession
    max_keys, max_bytes, max_literals = limits
    found = distinct_keys(df, keys)
    path = scratch_path(spark, "scope")
    found.write.parquet(path)
    kept = spark.read.schema(found.schema).parquet(path)
    size = F.sum(F.lit(16) + sum((F.coalesce(F.octet_length(F.col(f"key_{j}").cast("string")), F.lit(0)) for j in range(len(keys))), F.lit(0)))
    sizes = {r["key_no"]: (r["n"], r["size"]) for r in kept.groupBy("key_no").agg(F.count(F.lit(1)).alias("n"), size.alias("size")).collect()}
    out = {}
    for j, key in enumerate(keys):
        n, n_bytes = sizes.get(j, (0, 0))
        frame = kept.where(F.col("key_no") == j).select(F.col(f"key_{j}").alias(key))
        if n <= max_literals:
            out[key] = _KeySet(key, values=[r[0] for r in frame.collect()], size=n, dtype=df.schema[key].dataType)
        else:
            out[key] = _KeySet(key, frame=frame, size=n, broadcast=n <= max_keys and n_bytes <= max_bytes, dtype=df.schema[key].dataType)
    return out


@dataclass
class ResolvedScope:
    parts: dict[str, _KeySet] = field(default_factory=dict)

    @property
    def keys(self) -> list[str]:
        return list(self.parts)

    @property
    def stays_put(self) -> bool:
        """Whether no row moves when it is compared with the scope: literal or broadcast value sets only."""
        return all(p.literal or p.broadcast for p in self.parts.values())

    def size(self, key: str) -> int:
        return self.parts[key].size

    def literal_predicate(self) -> Column | None:
        """The slice as one Column if every set is literal, else None."""
        if not all(p.literal for p in self.parts.values()):
            return None
        pred = None
        for ks in self.parts.values():
            term = values_in(ks.key, ks.values)
            pred = term if pred is None else pred & term
        return null_safe_true(pred if pred is not None else F.lit(True))

    def key_frame(self, key: str) -> DataFrame:
        """The value set of ``key`` as a one-column DataFrame (for SQL / joins)."""
        ks = self.parts[key]
        if ks.literal:
            spark = SparkSession.getActiveSession()
            rows = [(v,) for v in ks.values if v is not None]
            if ks.dtype is not None:
                return spark.createDataFrame(rows, T.StructType([T.StructField(key, ks.dtype, True)]))
            return spark.createDataFrame(rows, [key])
        return ks.frame

    def _side(self, ks: _KeySet, alias: str, marker: str | None) -> DataFrame:
        cols = [F.col(ks.key).alias(alias)]
        if marker:
            cols.append(F.lit(True).alias(marker))
        side = ks.frame.select(*cols)
        return F.broadcast(side) if ks.broadcast else side

    def mark(self, df: DataFrame, flag: str = "_in_scope") -> DataFrame:
        """Add boolean ``flag`` (never null): is the row inside the slice?"""
        pred = self.literal_predicate()
        if pred is not None:
            return df.withColumn(flag, pred)
        terms: list[Column] = []
        markers: list[str] = []
        for i, ks in enumerate(self.parts.values()):
            if ks.literal:
                terms.append(values_in(ks.key, ks.values))
                continue
            alias, marker = f"__scope_k{i}", f"__scope_m{i}"
            side = self._side(ks, alias, marker)
            df = df.join(side, df[ks.key] == side[alias], "left").drop(alias)
            terms.append(F.col(marker).isNotNull())
            markers.append(marker)
        pred = terms[0]
        for t in terms[1:]:
            pred = pred & t
        return df.withColumn(flag, null_safe_true(pred)).drop(*markers)

    def select(self, df: DataFrame) -> DataFrame:
        """Rows inside the slice (left-semi joins / pushed-down IN filters)."""
        for i, ks in enumerate(self.parts.values()):
            if ks.literal:
                # A filter drops null predicates anyway; the bare IN reaches the Parquet scan.
                df = df.filter(values_in(ks.key, ks.values))
            else:
                alias = f"__scope_k{i}"
                side = self._side(ks, alias, None)
                df = df.join(side, df[ks.key] == side[alias], "left_semi")
        return df

    def exclude(self, df: DataFrame) -> DataFrame:
        """Rows outside the slice, rows with null keys included."""
        flag = "__in_scope"
        return self.mark(df, flag).filter(~F.col(flag)).drop(flag)
