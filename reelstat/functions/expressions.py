"""Column expressions shared by the operators.

All are built-in Spark functions, so they stay inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that results depend on.
NO_GENRE = "(no genres listed)"       # genre sentinel of the source data set
YEAR_PATTERN = r"\((\d{4})\)"          # first "(dddd)" in a title is the release year
GENRE_SEPARATOR = "|"                  # genres are a pipe-separated list
DATE_FORMAT = "yyyy-MM-dd"


def col_(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def round_half_up(c, scale: int) -> Column:
    """Round a double half-up at ``scale`` decimals through decimal(38,12).

    Going through a fixed decimal first makes the result independent of
    how the engine prints the binary double (1.005 -> 1.01), so an
    independent SQL engine applying the same cast gets the same digits.
    Twelve decimals are the most at which such engines agree on a double near
    5, and enough that a mean just under a half step (2.4949999999) rounds down.
    """
    return F.round(col_(c).cast("decimal(38,12)"), scale).cast("double")


def percent(part, whole, scale: int = 2) -> Column:
    return round_half_up(col_(part).cast("double") * F.lit(100.0) / col_(whole), scale)


def epoch_to_date(ts, tz: str | None = None) -> Column:
    """Epoch seconds -> ``YYYY-MM-DD``.

    ``tz=None`` formats in the session zone (UTC by default in this
    engine); a named zone converts the wall clock first.
    """
    t = F.timestamp_seconds(col_(ts))
    if tz is None:
        return F.date_format(t, DATE_FORMAT)
    local = F.convert_timezone(F.current_timezone(), F.lit(tz), t.cast("timestamp_ntz"))
    return F.date_format(local, DATE_FORMAT)


def release_year(title) -> Column:
    """Four digits of the first ``(dddd)`` in the title, '' when none."""
    return F.regexp_extract(col_(title), YEAR_PATTERN, 1)


def main_genre(genres) -> Column:
    """First entry of the pipe list (the whole string when no pipe)."""
    return F.split_part(col_(genres), F.lit(GENRE_SEPARATOR), F.lit(1))


def has_year(year) -> Column:
    c = col_(year)
    return c.isNotNull() & (c != F.lit(""))


# Fixed values of the key hash: arithmetic modulo the Mersenne prime 2^31 - 1.
HASH_PRIME = (1 << 31) - 1
HASH_MULT = 0x45D9F3B
HASH_KEYS = (0x2545F491, 0x5851F42D, 0x14057B7E)   # one xor constant per round


def hash_bucket(cols, seed: int, buckets: int) -> Column:
    """Partition-independent bucket in ``[0, buckets)`` from integer key columns.

    Each key (its low 31 bits) is xor-folded into a running value that
    starts at ``seed``, then mixed by three rounds of "xor a constant,
    multiply modulo 2^31 - 1".  Every round references the running value
    once, so the expression stays linear in size wherever the optimizer
    inlines it (into a filter or a join condition).  Products stay below
    2^58: no bigint overflow under ANSI.  The same key lands in the same
    bucket whatever the partitioning or executor count (unlike
    ``randomSplit``), and the rule is plain integer arithmetic that any SQL
    engine evaluates alike.
    """
    x = F.lit(seed % HASH_PRIME).cast("bigint")
    for c in cols:
        x = x.bitwiseXOR(col_(c).cast("bigint").bitwiseAND(F.lit(0x7FFFFFFF)))
        for k in HASH_KEYS:
            x = (x.bitwiseXOR(F.lit(k)) % F.lit(HASH_PRIME)) * F.lit(HASH_MULT) % F.lit(HASH_PRIME)
    return x % F.lit(buckets)


def hash_bucket_sql(cols, seed: int, buckets: int) -> str:
    """The same rule as ``hash_bucket`` in SQL text (xor() function syntax)."""
    x = f"CAST({seed % HASH_PRIME} AS BIGINT)"
    for c in cols:
        x = f"xor({x}, CAST({c} AS BIGINT) & {0x7FFFFFFF})"
        for k in HASH_KEYS:
            x = f"(xor({x}, {k}) % {HASH_PRIME}) * {HASH_MULT} % {HASH_PRIME}"
    return f"({x}) % {buckets}"
