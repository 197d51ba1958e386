"""Small SQL text helpers for the oracles."""


def rnd(x: str, digits: int) -> str:
    """Scale, round half to even, scale back."""
    return f"(round_even(CAST(({x}) AS DOUBLE) * {10**digits}.0::DOUBLE, 0) / {10**digits}.0::DOUBLE)"


def msum(x: str, where: str | None = None, digits: int = 2) -> str:
    """Exact sum of an amount over ten-thousandths, as a double."""
    filter_ = f" FILTER (WHERE {where})" if where else ""
    units = f"CAST(round_even(CAST(({x}) AS DOUBLE) * 10000.0::DOUBLE, 0) AS BIGINT)"
    return f"coalesce({rnd(f'CAST(sum({units}){filter_} AS DOUBLE) / 10000.0::DOUBLE', digits)}, 0.0::DOUBLE)"


def lsum(x: str, where: str | None = None) -> str:
    filter_ = f" FILTER (WHERE {where})" if where else ""
    return f"CAST(coalesce(sum({x}){filter_}, 0) AS BIGINT)"


def cnt(where: str) -> str:
    return f"count(*) FILTER (WHERE {where})"


def div(num: str, den: str, digits: int | None = None, zero: str | None = None, times: str | None = None) -> str:
    x = f"CAST(({num}) AS DOUBLE) / nullif(CAST(({den}) AS DOUBLE), 0)"
    if times:
        x = f"({x}) * {times}"
    if digits is not None:
        x = rnd(x, digits)
    return f"coalesce({x}, {zero})" if zero else f"({x})"


def delta(cur: str, prev: str) -> str:
    return (
        f"(CASE WHEN ({prev}) = 0 AND ({cur}) = 0 THEN 0.0 WHEN ({prev}) = 0 THEN 100.0 "
        f"ELSE (CAST(({cur}) AS DOUBLE) - ({prev})) / nullif(CAST(({prev}) AS DOUBLE), 0) * 100.0 END)"
    )


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(c.strip() for c in ctes) + "\n"
