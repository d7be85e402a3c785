"""Column expressions: constraints, bands, codes, draws, labels, keys and errors. All stay inside Catalyst."""

from __future__ import annotations

import functools
import math
import operator
from collections.abc import Iterable, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# The multipliers and the shift of the string hash.
HASH_STEP, HASH_MIX, HASH_SHIFT = 31, 0xFF51AFD7ED558CCD, 33

# ---- constraints ----

OPS = {"==": operator.eq, "=": operator.eq, "!=": operator.ne, ">": operator.gt, ">=": operator.ge, "<": operator.lt, "<=": operator.le}
WORD_OPS = {"equals": "==", "is": "==", "not_equals": "!=", "<>": "!=", "greater_than": ">", "greater_than_or_equal": ">=", "less_than": "<", "less_than_or_equal": "<="}


def literal(text: str):
    """A constraint's text as number, boolean or string."""
    try:
        n = float(text)
    except ValueError:
        return {"true": True, "false": False}.get(text.lower(), text)
    return int(n) if math.isfinite(n) and n == int(n) else n


def constraint(column: Column, op: str, value: str) -> Column:
    """``column op value``; an unknown operator is an error; a null satisfies nothing."""
    if op not in OPS:
        raise ValueError(f"unknown operator {op!r}")
    return F.coalesce(OPS[op](column, F.lit(literal(value))), F.lit(False))


def constraint_words(column: Column, op: str, value: str) -> Column:
    """The second spelling: words for operators, and ``in`` with a ``|`` list."""
    if op == "in":
        return F.coalesce(column.isin([literal(v.strip()) for v in value.split("|")]), F.lit(False))
    return constraint(column, WORD_OPS.get(op, op), value)


def conjunction(constraints: Iterable[tuple[str, str, str]], columns: Sequence[str]) -> Column:
    """All of ``(variable, op, value)``; a variable that is no column makes it false; no constraint makes it true."""
    parts = [constraint(F.col(v), o, x) if v in columns else F.lit(False) for v, o, x in constraints]
    return functools.reduce(operator.and_, parts, F.lit(True))


def holds(actual: Column, op: Column, bound: Column) -> Column:
    """``actual op bound`` where operator and bound are data."""
    return F.coalesce(
        F.when(op.isin("==", "="), actual == bound).when(op == "!=", actual != bound).when(op == ">", actual > bound)
        .when(op == ">=", actual >= bound).when(op == "<", actual < bound).when(op == "<=", actual <= bound),
        F.lit(False),
    )


# ---- bands and codes ----


def band(x: Column, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """Half-open bands ``[edges[i], edges[i+1])``; the last label is the default."""
    out = None
    for lo, hi, label in zip(edges, edges[1:], labels):
        cond = (x >= lo) & (x < hi)
        out = F.when(cond, label) if out is None else out.when(cond, label)
    return out.otherwise(labels[-1])


def closed_band(x: Column, width: int, top: int) -> Column:
    """Lower bound of closed bands of ``width``, open from ``top``."""
    return F.least(F.floor(x / width) * width, F.lit(top)).cast("int")


def child_bucket(n: Column, top: int = 3) -> Column:
    return F.least(n, F.lit(top))


def recode(x: Column, codes: dict, default=None) -> Column:
    m = F.create_map(*[F.lit(v) for kv in codes.items() for v in kv])
    found = F.try_element_at(m, x)
    return F.coalesce(found, F.lit(default)) if default is not None else found


def first_matching(rules: Sequence[tuple[Column, str]], default: str) -> Column:
    out = functools.reduce(lambda acc, r: acc.when(*r) if acc is not None else F.when(*r), rules, None)
    return out.otherwise(default)


def where_code(pairs: Sequence[tuple[Column, Column]], code) -> Column:
    """Sum of the values whose code column equals ``code``."""
    return functools.reduce(operator.add, [F.when(c == code, v).otherwise(0) for c, v in pairs])


def positive_part(x: Column) -> Column:
    return F.greatest(x, F.lit(0.0))


def negative_part(x: Column) -> Column:
    return F.greatest(-x, F.lit(0.0))


def guarded_ratio(a: Column, b: Column, low: float, high: float, default: float = 1.0) -> Column:
    return F.when(b > 0, F.least(F.greatest(a / b, F.lit(low)), F.lit(high))).otherwise(F.lit(default))


def ordered_sum(x: str) -> Column:
    """A group's sum, the same to the last bit however its rows arrive: added from the smallest value on; for short groups."""
    return F.when(F.count(x) > 0, F.aggregate(F.array_sort(F.collect_list(F.col(x).cast("double"))), F.lit(0.0), lambda a, b: a + b))


def largest_of(columns: Sequence[str]) -> Column:
    """The name of the largest column; ties go to the first."""
    return F.array_max(F.array(*[F.struct(F.col(c).alias("v"), F.lit(-i).alias("o"), F.lit(c).alias("n")) for i, c in enumerate(columns)]))["n"]


def waterfall(amount: Column, caps: Sequence[Column]) -> list[Column]:
    """``amount`` poured into pools of the given capacities, one after the other."""
    out, left = [], F.greatest(amount, F.lit(0.0))
    for cap in caps:
        out.append(F.least(left, F.greatest(cap, F.lit(0.0))))
        left = left - out[-1]
    return out


# ---- draws ----


def lcg_uniform(key: Column, salt: int = 0) -> Column:
    """A reproducible uniform in [0, 1) from an integer key."""
    return ((key.cast("long") * (1103515245 + salt) + 12345 + salt) % 2147483648) / F.lit(2147483648.0)


def hash_uniform(*keys) -> Column:
    """A reproducible uniform in [0, 1) from any keys."""
    return F.pmod(F.xxhash64(*keys), F.lit(1 << 53)) / F.lit(float(1 << 53))


@F.pandas_udf(StringType())
def string_hash(s: pd.Series) -> pd.Series:
    """A 64-bit polynomial hash of the UTF-8 bytes with a final mix (arithmetic wraps), as unsigned decimal text.

    The polynomial of a whole batch is one product of its bytes with powers, added up per text.
    """
    raw = [b"" if t is None else t.encode("utf-8") for t in s]
    size = np.array([len(b) for b in raw], np.int64)
    h = np.zeros(len(raw), np.uint64)
    if size.sum():
        powers = np.full(int(size.max()), HASH_STEP, np.uint64)
        powers[0] = 1
        powers = np.cumprod(powers)
        some = size > 0
        ends = np.cumsum(size[some])
        place = np.repeat(ends, size[some]) - 1 - np.arange(ends[-1])
        h[some] = np.add.reduceat(np.frombuffer(b"".join(raw), np.uint8).astype(np.uint64) * powers[place], ends - size[some])
    h ^= h >> np.uint64(HASH_SHIFT)
    h *= np.uint64(HASH_MIX)
    h ^= h >> np.uint64(HASH_SHIFT)
    return pd.Series([None if t is None else str(x) for t, x in zip(s, h.tolist())], dtype=object)


# ---- labels and keys ----


def amount_label(x: Column) -> Column:
    """``inf``, ``-inf``, ``3bn``, ``25m``, ``10k`` or the plain number, halves to even."""
    a = F.abs(x)
    text = lambda d: F.bround(x / d, 0).cast("long").cast("string")
    return (
        F.when(x == float("inf"), "inf").when(x == float("-inf"), "-inf")
        .when(a >= 1e9, F.concat(text(1e9), F.lit("bn"))).when(a >= 1e6, F.concat(text(1e6), F.lit("m")))
        .when(a >= 1e3, F.concat(text(1e3), F.lit("k"))).otherwise(text(1.0))
    )


def range_label(lo: Column, hi: Column) -> Column:
    return F.concat(F.when(lo <= 0, "-inf").otherwise(amount_label(lo)), F.lit("_"), amount_label(hi))


def split_label(name: Column) -> list[Column]:
    """``geo/variable/filter``: three columns, missing parts null."""
    p = F.split(name, "/", 3)
    return [F.get(p, F.lit(i)) for i in range(3)]


def filter_bounds(text: Column, variable: str) -> tuple[Column, Column, Column]:
    """Lower and upper bound of ``variable`` in a bracketed filter, and the filter without them."""
    lo = F.regexp_extract(text, rf"{variable}\s*>=?\s*([-+.\w]+)", 1)
    hi = F.regexp_extract(text, rf"{variable}\s*<=?\s*([-+.\w]+)", 1)
    inner = F.regexp_replace(text, r"^\[|\]$", "")
    kept = F.array_join(F.filter(F.split(inner, ","), lambda x: ~F.trim(x).startswith(variable)), ",")
    return F.nullif(lo, F.lit("")).try_cast("double"), F.nullif(hi, F.lit("")).try_cast("double"), kept


def ucgid_of(level: Column, key: Column) -> Column:
    return F.when(level == "national", "0100000US").when(level == "state", F.concat(F.lit("0400000US"), F.lpad(key, 2, "0"))).when(level == "district", F.concat(F.lit("5001800US"), F.lpad(key, 4, "0")))


def ucgid_parts(ucgid: Column) -> tuple[Column, Column, Column]:
    """Level, state and district number of a geographic id; district 00 and 98 count as 01."""
    level = F.when(ucgid == "0100000US", "national").when(ucgid.startswith("0400000US"), "state").when(ucgid.startswith("5001800US") | ucgid.startswith("5001900US"), "district")
    state = F.when(level.isin("state", "district"), F.substring(ucgid, 10, 2).try_cast("int"))
    d = F.substring(ucgid, 12, 2).try_cast("int")
    return level, state, F.when(level == "district", state * 100 + F.when(d.isin(0, 98), 1).otherwise(d))


def block_parts(block: Column) -> tuple[Column, Column, Column]:
    """State, county and tract of a block id."""
    return F.substring(block, 1, 2), F.substring(block, 1, 5), F.substring(block, 1, 11)


def geo_rank(key: Column) -> Column:
    """0 nation, 1 state, 2 district, 3 anything else."""
    n = key.try_cast("int")
    return F.when(key == "US", 0).when(n.isNull(), 3).when(n < 100, 1).otherwise(2)


def age_bounds(text: Column) -> tuple[Column, Column]:
    """``a-b`` or ``a+`` as bounds; ``a+`` has no upper bound."""
    return F.regexp_extract(text, r"^(\d+)", 1).try_cast("int"), F.regexp_extract(text, r"-(\d+)$", 1).try_cast("int")


def definition_hash(parent: Column, texts: Column) -> Column:
    """SHA-256 of the parent's id and the sorted constraint texts."""
    head = F.coalesce(parent.cast("string"), F.lit(""))
    return F.sha2(F.when(F.size(texts) > 0, F.concat(head, F.lit("\n"), F.array_join(F.array_sort(texts), "\n"))).otherwise(head), 256)


def money_text(x: Column) -> Column:
    """``$1.2B``, ``-$350.0K`` or ``$12``; ``n/a`` for null, NaN and infinities. For reports; halves go up."""
    a, sign = F.abs(x), F.when(x < 0, "-").otherwise("")
    sized = F.when(a < 1e3, F.format_string("%.0f", a)).otherwise(F.lit(None).cast("string"))
    for scale, suffix in ((1e12, "T"), (1e9, "B"), (1e6, "M"), (1e3, "K")):
        sized = F.coalesce(sized, F.when(a >= scale, F.concat(F.format_string("%.1f", a / scale), F.lit(suffix))))
    return F.when(x.isNull() | F.isnan(x) | (a == float("inf")), "n/a").otherwise(F.concat(sign, F.lit("$"), sized))


def percent_text(x: Column, signed: bool = False) -> Column:
    """A share as ``12.34%`` (with a sign if ``signed``); ``n/a`` for null, NaN and infinities."""
    return F.when(x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")), "n/a").otherwise(F.concat(F.format_string("%+.2f" if signed else "%.2f", x * 100), F.lit("%")))


def bar_text(x: Column, top: Column, width: int = 28) -> Column:
    """``x`` as a bar of ``#`` over dots, full at ``top``; all dots where either is no positive number."""
    share = F.least(F.abs(x) / F.abs(top), F.lit(1.0))
    n = F.coalesce(F.when(share.isNotNull() & ~F.isnan(share), F.bround(share * width, 0).cast("int")), F.lit(0))
    return F.concat(F.repeat(F.lit("#"), n), F.repeat(F.lit("."), F.lit(width) - n))


# ---- errors ----


def relative_error(est: Column, target: Column) -> Column:
    """(est - target) / |target|, 0 where the target is 0."""
    return F.when(target != 0, (est - target) / F.abs(target)).otherwise(F.lit(0.0))


def relative_error_inf(est: Column, target: Column) -> Column:
    """As above, but infinite for a zero target unless both are zero."""
    return F.when(target != 0, (est - target) / F.abs(target)).when(est == 0, F.lit(0.0)).when(est > 0, F.lit(float("inf"))).otherwise(F.lit(float("-inf")))


def smoothed_square_error(est: Column, target: Column) -> Column:
    e = (est - target + 1) / (target + 1)
    return e * e


def severity(percent: Column) -> Column:
    a = F.abs(percent)
    return F.when(percent.isNull() | F.isnan(percent) | (a < 1), "ok").when(a < 5, "flag").when(a < 15, "significant").otherwise("critical")
