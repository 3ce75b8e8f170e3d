"""Reading one source table with many tasks: predicates that share its rows out evenly, under the delta condition of a run."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass
from decimal import ROUND_CEILING, Decimal

Ask = Callable[[str], Iterable]
# Bins that a range is counted in at a time, how often a full bin is cut again, and full bins are those above this share of a part.
BINS = 256
ROUNDS = 12
FULL = 4


@dataclass(frozen=True)
class Range:
    """Values from ``low`` on and below ``high``, which are open where None, and how many rows were counted there."""

    low: Decimal | None
    high: Decimal | None
    rows: int

    def condition(self, column: str) -> str:
        bounds = [f"{column} {op} {_number(x)}" for op, x in ((">=", self.low), ("<", self.high)) if x is not None]
        return " AND ".join(bounds) or f"{column} IS NOT NULL"


@dataclass(frozen=True)
class Part:
    """A condition and how many rows met it when it was made."""

    condition: str
    rows: int


def split(ask: Ask, source: str, column: str, parts: int, where: str | None = None, second: str | None = None) -> list[Part]:
    """Conditions that share out the rows of ``source`` (a table or a query in brackets with a name) that meet ``where``.

    ``column`` is a numeric column or expression. Every row meets just one condition, whatever arrives after the
    counting: the first and last range are open, and rows without a value have a condition of their own. Ranges
    follow how the values lie, counted by the database in bins that are cut again where they are full, so that a
    part holds no more than twice the average. A single value with more rows than that is cut by ``second``,
    and so are the rows without a value.

    ``ask`` runs a SQL text in the database and returns its rows. Each text is one grouped count over a range.
    """
    if parts < 1:
        raise ValueError("a split has one part at least")
    about = list(ask(f"SELECT MIN({column}) AS lo, MAX({column}) AS hi, COUNT({column}) AS n, COUNT(*) AS total FROM {source}{_where(where)}"))[0]
    low, high, n, total = about[0], about[1], int(about[2] or 0), int(about[3] or 0)
    goal = max(1, -(-total // parts))
    out: list[Part] = []
    if n:
        bins = _bins(ask, source, column, Range(Decimal(str(low)), _above(Decimal(str(high))), n), goal, where)
        packed = _packed(bins, goal)
        for k, (first, last, rows, hot) in enumerate(packed):
            span = Range(None if k == 0 else first, None if k == len(packed) - 1 else last, rows)
            out += _cut(ask, source, span.condition(column), rows, goal, where, second if hot else None)
    else:
        out.append(Part(f"{column} IS NOT NULL", 0))
    return out + _cut(ask, source, f"{column} IS NULL", total - n, goal, where, second)


def _cut(ask: Ask, source: str, condition: str, rows: int, goal: int, where: str | None, second: str | None) -> list[Part]:
    """One part, or several by a second column if it is too large."""
    if second is None or rows <= goal:
        return [Part(condition, rows)]
    inner = split(ask, source, second, -(-rows // goal), f"({where}) AND ({condition})" if where else condition)
    return [Part(f"({condition}) AND ({p.condition})", p.rows) for p in inner]


def _bins(ask: Ask, source: str, column: str, whole: Range, goal: int, where: str | None) -> list[Range]:
    """Ranges in order that fill ``whole``, cut until none is full or can be cut."""
    done, full = [], [whole]
    for _ in range(ROUNDS):
        cut: list[Range] = []
        for r in full:
            if r.rows * FULL <= goal or r.high - r.low <= _step(r):
                done.append(r)
            else:
                cut += _counted(ask, source, column, r, where)
        full = cut
        if not full:
            break
    return sorted(done + full, key=lambda r: r.low)


def _counted(ask: Ask, source: str, column: str, r: Range, where: str | None) -> list[Range]:
    """The range cut into bins of equal width with their rows, neighbouring empty ones as one."""
    width = (r.high - r.low) / BINS
    if _whole(r):
        width = max(Decimal(1), width.to_integral_value(ROUND_CEILING))
    size = int(((r.high - r.low) / width).to_integral_value(ROUND_CEILING))
    inside = f"({where}) AND ({r.condition(column)})" if where else r.condition(column)
    bin_ = f"FLOOR(({column} - {_number(r.low)}) * 1.0 / {_number(width)})"
    counts = {int(b): int(c) for b, c in ask(f"SELECT b, COUNT(*) AS n FROM (SELECT {bin_} AS b FROM {source} WHERE {inside}) AS bins GROUP BY b")}
    # Edges are written with as many digits as a double holds, and the outer ones stay as they are: neighbours meet exactly.
    inner = [r.low + k * width for k in range(1, size)]
    edges = [r.low, *(inner if _whole(r) else [min(max(Decimal(f"{e:.15g}"), r.low), r.high) for e in inner]), r.high]
    out: list[Range] = []
    for k, (low, high) in enumerate(zip(edges, edges[1:])):
        # A bin counted beyond the end by the database's own arithmetic is the last one.
        rows = counts.get(k, 0) if k < size - 1 else sum(c for b, c in counts.items() if b >= k)
        if out and not rows and not out[-1].rows:
            out[-1] = Range(out[-1].low, high, 0)
        else:
            out.append(Range(low, high, rows))
    return out


def _packed(bins: list[Range], goal: int) -> list[tuple[Decimal, Decimal, int, bool]]:
    """Neighbouring bins together up to a part's rows; one that alone has more stays alone and is marked."""
    out: list[tuple[Decimal, Decimal, int, bool]] = []
    for r in bins:
        if out and not out[-1][3] and out[-1][2] + r.rows <= goal:
            low, _, rows, _ = out[-1]
            out[-1] = (low, r.high, rows + r.rows, False)
        else:
            out.append((r.low, r.high, r.rows, r.rows > goal))
    return out


def _whole(r: Range) -> bool:
    return r.low == r.low.to_integral_value() and r.high == r.high.to_integral_value()


def _step(r: Range) -> Decimal:
    """The width that is not cut further."""
    return Decimal(1) if _whole(r) else max(abs(r.low), abs(r.high)) * Decimal("1e-15")


def _above(x: Decimal) -> Decimal:
    """A bound that x itself is below."""
    return x + 1 if x == x.to_integral_value() else x + max(abs(x), Decimal(1)) * Decimal("1e-9")


def _number(x: Decimal) -> str:
    return str(int(x)) if x == x.to_integral_value() else format(x, "f")


def _where(text: str | None) -> str:
    return f" WHERE {text}" if text else ""
