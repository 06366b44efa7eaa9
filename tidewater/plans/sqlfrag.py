"""SQL text fragments shared by the oracle statements (DuckDB dialect)."""

from __future__ import annotations


def rdiv(num: str, den: str, p: int = 2, sn: int = 0, sd: int = 0) -> str:
    """num / den rounded half-up to ``p`` decimals, exactly, as DOUBLE.

    DuckDB divides decimals in floating point, so a quotient such as 9.575
    may round down; this works on scaled integers instead.  ``sn``/``sd``
    are the decimal scales of the numerator and denominator.  NULL when the
    denominator is 0.
    """
    a = f"CAST(round(({num}) * {10 ** sn}) AS HUGEINT)"
    b = f"CAST(round(({den}) * {10 ** sd}) AS HUGEINT)"
    n = f"({a} * {10 ** (sd + p)})"
    d = f"NULLIF({b} * {10 ** sn}, 0)"
    return (f"(CAST(sign({n}) * sign({d}) * ((2 * abs({n}) + abs({d})) // (2 * abs({d}))) AS DOUBLE)"
            f" / {10 ** p})")


def rpct(num: str, den: str, p: int = 2, sn: int = 0, sd: int = 0) -> str:
    """100 * num / den rounded half-up to ``p`` decimals, as DOUBLE."""
    return rdiv(f"({num}) * 100", den, p, sn, sd)


def ravg(col: str, p: int = 2, s: int = 0) -> str:
    """Exact average of ``col`` (scale ``s``) rounded half-up, as DOUBLE."""
    return rdiv(f"sum({col})", f"count({col})", p, s, 0)
