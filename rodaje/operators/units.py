"""Quantities recorded in different units, brought to one by a hidden Markov model per series.

The hidden state of a record is its unit. Where the record names its unit the state is known; where it is silent,
Viterbi decoding picks the units that keep the level of the series smooth: a jump of the log value costs in
proportion to its size, a switch of unit costs a constant, and so does any unit but the usual one. Records are dealt to
tasks by ranges of (series, date, id), so a series of any length is spread over as many tasks as it fills. Minimal path
costs between the ends of its parts compose like matrices: the parts are decoded in parallel and give the one best path of the whole series.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from rodaje.session import cut

#: Units of money: factor, and whether the amount is in dollars.
UNITS: dict[str, tuple[str, bool]] = {
    "pesos": ("1", False), "miles": ("1000", False), "millones": ("1000000", False), "centavos": ("0.01", False),
    "usd": ("1", True), "kusd": ("1000", True),
}

#: Cost of a jump by a factor e, of a switch of unit, of a silent record in another unit than the usual, and of being off
#: the table's general level by a factor e.
JUMP, SWITCH, UNUSUAL, OFF = 2.0, 1.0, 1.5, 1.0

#: Of paths that cost the same the one through lower states counts, wherever a series is parted.
TIE = 1e-7


def _moves(before: np.ndarray, now: np.ndarray) -> np.ndarray:
    """Cost of going from each state (axis 1) of one record to each (axis 2) of the next."""
    n = before.shape[1]
    return JUMP * np.abs(now[:, None, :] - before[:, :, None]) + SWITCH * (1 - np.eye(n))


def viterbi(
    level: np.ndarray, cost: np.ndarray, starts: np.ndarray, first: np.ndarray | None = None, last: np.ndarray | None = None
) -> np.ndarray:
    """The best state of every row; chains start at `starts` and are decoded side by side.

    first and last give known end states of chains, -1 where open. Ties go to the lower state.
    """
    ends = np.concatenate([starts[1:], [len(level)]])
    size = ends - starts
    order = np.argsort(-size, kind="stable")
    starts, size = starts[order], size[order]
    back = np.zeros(level.shape, dtype=np.int8)
    total = cost[starts].copy()
    if first is not None:
        fixed = first[order]
        known = fixed >= 0
        only = np.full_like(total[known], np.inf)
        only[np.arange(len(only)), fixed[known]] = total[known, fixed[known]]
        total[known] = only
    for t in range(1, int(size[0]) if len(size) else 0):
        live = int(np.searchsorted(-size, -t, side="left"))
        rows = starts[:live] + t
        step = total[:live, :, None] + _moves(level[rows - 1], level[rows])
        back[rows] = step.argmin(axis=1)
        total[:live] = step.min(axis=1) + cost[rows]
    state = np.zeros(len(level), dtype=np.int8)
    final = total.argmin(axis=1)
    if last is not None:
        final = np.where(last[order] >= 0, last[order], final)
    state[starts + size - 1] = final
    for t in range(int(size[0]) - 1 if len(size) else 0, 0, -1):
        live = int(np.searchsorted(-size, -t, side="left"))
        rows = starts[:live] + t
        state[rows - 1] = back[rows, state[rows]]
    return state


def _chained(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Least path costs over two stretches: matrix products in which sums take the place of products and minima that of sums."""
    return (a[:, :, :, None] + b[:, None, :, :]).min(axis=2)


def _through(paths: np.ndarray | None, before: np.ndarray | None, level: np.ndarray, cost: np.ndarray) -> np.ndarray:
    """The least cost from each first to each last state over the records seen so far (paths, ending at level before) and these."""
    n = level.shape[1]
    if paths is None:
        paths = np.where(np.eye(n, dtype=bool), cost[0][:, None], np.inf)
        before, level, cost = level[0], level[1:], cost[1:]
    if not len(level):
        return paths
    steps = _moves(np.concatenate([before[None], level[:-1]]), level) + cost[:, None, :]
    while len(steps) > 1:
        odd = steps[-1:] if len(steps) % 2 else steps[:0]
        steps = np.concatenate([_chained(steps[: len(steps) // 2 * 2 : 2], steps[1::2]), odd])
    return _chained(paths[None], steps)[0]


class _Model:
    """Levels and costs of the states of records, from the logs of amount and rate and the unit they state (-1: none)."""

    def __init__(self, units: Mapping[str, tuple[str, bool]], usual: str, silent: Sequence[str], middle: float | None) -> None:
        self.factor = np.array([float(np.log(float(f))) for f, _ in units.values()])
        self.dollars = np.array([d for _, d in units.values()])
        self.open = np.array([0.0 if n == usual else UNUSUAL if n in silent else np.inf for n in units])
        self.middle = middle

    def __call__(self, table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        x, fx, said = (table.column(c).to_numpy() for c in ("_x", "_fx", "_said"))
        # An amount in dollars without a rate has no level.
        level = np.nan_to_num(x[:, None] + self.factor + np.where(self.dollars, fx[:, None], 0.0), nan=0.0)
        free = self.open + (0.0 if self.middle is None else OFF * np.abs(level - self.middle))
        states = np.arange(len(self.factor))
        stated = np.where(said[:, None] == states, 0.0, np.inf)
        return level, np.where(said[:, None] < 0, free, stated) + TIE * states, table.column("_series").to_numpy()


def _bounds(series: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.concatenate([[True], series[1:] != series[:-1]]))


def _transfer(model: _Model) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Of the first and the last series of a part, which others may share: least path costs, and the levels at both ends."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: list = []  # series, paths, first level, last level
        out: list[list] = []
        part = None
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch])
            part = table.column("_part")[0].as_py()
            level, cost, series = model(table)
            starts = [*_bounds(series), len(series)]
            if now and now[0] == series[0]:
                now[1] = _through(now[1], now[3], level[: starts[1]], cost[: starts[1]])
                now[3] = level[starts[1] - 1]
                starts = starts[1:]
            # The first series of the part, and the last one of the batch, which may go on.
            for a, b in zip(starts, starts[1:]):
                if not out and now:
                    out.append(now)
                if b < len(series) and (out or now):
                    continue
                now = [series[a], _through(None, None, level[a:b], cost[a:b]), level[a], level[b - 1]]
        if now:
            out.append(now)
        if out:
            yield pa.RecordBatch.from_pydict(
                {
                    "series": [int(o[0]) for o in out], "part": pa.array([part] * len(out), pa.int32()), "paths": [o[1].ravel().tolist() for o in out],
                    "head": [o[2].tolist() for o in out], "tail": [o[3].tolist() for o in out],
                }
            )

    return run


def _ends(parts: Sequence[tuple], states: int) -> dict[tuple[int, int], tuple[int, int]]:
    """(series, part): the first and the last state of each part on the best path of its series."""
    by: dict[int, list] = {}
    for series, part, paths, head, tail in parts:
        by.setdefault(series, []).append((part, np.array(paths).reshape(states, states), np.array(head), np.array(tail)))
    out = {}
    for series, rows in by.items():
        rows.sort(key=lambda r: r[0])
        into, entry, back = np.zeros(states), [], []
        for i, (_, paths, head, _) in enumerate(rows):
            if i:
                move = total[:, None] + _moves(rows[i - 1][3][None], head[None])[0]
                into = move.min(axis=0)
                back.append(move.argmin(axis=0))
            step = into[:, None] + paths
            entry.append(step.argmin(axis=0))
            total = step.min(axis=0)
        s = int(total.argmin())
        for i in range(len(rows) - 1, -1, -1):
            out[series, rows[i][0]] = int(entry[i][s]), s
            s = int(back[i - 1][entry[i][s]]) if i else s
    return out


def _decode(model: _Model, ends: Mapping[tuple[int, int], tuple[int, int]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def decoded(table: pa.Table) -> Iterator[pa.RecordBatch]:
        level, cost, series = model(table)
        starts = _bounds(series)
        part = table.column("_part")[0].as_py()
        known = np.array([ends.get((int(series[a]), part), (-1, -1)) for a in starts])
        state = viterbi(level, cost, starts, known[:, 0], known[:, 1])
        rows = table.drop_columns(["_series", "_part", "_x", "_fx", "_said"])
        yield from rows.append_column("_state", pa.array(state.astype(np.int32))).to_batches(max_chunksize=10_000)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            # What is held ends where a series ends; one that goes on is held longer.
            last = _bounds(batch.column("_series").to_numpy())[-1]
            if last or (held and held[-1].column("_series")[-1] != batch.column("_series")[0]):
                yield from decoded(pa.Table.from_batches([*held, batch.slice(0, last)] if last else held))
                held = []
            held.append(batch.slice(last))
        if held:
            yield from decoded(pa.Table.from_batches(held))

    return run


def decode_units(
    records: DataFrame, series: Sequence[str], at: str, id_col: str, amount: str, stated: str, rate: str, usual: str,
    silent: Sequence[str], units: Mapping[str, tuple[str, bool]] = UNITS, parts: int | None = None,
) -> DataFrame:
    """records with a column unit: the unit of every record's amount.

    stated is a unit's name or null; rate is the price of a dollar, used by dollar units and null if unknown. A silent record
    may be in the usual unit or one of `silent`. A series is what all its columns say, null included, and is ordered by `at` (null
    first) and then by id; the result does not depend on how it is parted (`parts`, default: as Spark chooses). Records without
    a positive amount keep what they state, or get the usual unit. A unit that is not listed counts as not stated.
    """
    names = list(units)
    amount_, live = F.col(amount).cast("double"), F.coalesce(F.col(amount) > 0, F.lit(False))
    place = F.array_position(F.array(*[F.lit(n) for n in names]), F.col(stated)) - 1
    factor = F.element_at(F.array(*[F.lit(float(np.log(float(f)))) for f, _ in units.values()]), (place + 1).cast("int"))
    fx = F.when(F.array(*[F.lit(d) for _, d in units.values()])[place.cast("int")], F.log(F.col(rate).cast("double"))).otherwise(0.0)
    middle = records.where(live & (place >= 0)).select(F.percentile_approx(F.coalesce(F.log(amount_) + factor + fx, F.lit(0.0)), 0.5)).first()[0]
    model = _Model(units, usual, silent, middle)
    key = F.xxhash64(*[x for c in series for x in (F.col(c).isNull(), F.col(c))])
    chain = records.where(live).select(
        "*", key.alias("_series"), F.log(amount_).alias("_x"), F.log(F.col(rate).cast("double")).alias("_fx"), F.coalesce(place, F.lit(-1)).cast("int").alias("_said")
    )
    order = ["_series", F.col(at).cast("date"), F.col(id_col)]
    ranged = chain.repartitionByRange(parts, *order) if parts else chain.repartitionByRange(*order)
    # Written once: both passes must see the same parts.
    placed = cut(ranged.sortWithinPartitions(*order).withColumn("_part", F.spark_partition_id()))
    transfers = placed.mapInArrow(_transfer(model), "series long, part int, paths array<double>, head array<double>, tail array<double>")
    # At most two rows a part.
    ends = _ends([tuple(r) for r in transfers.collect()], len(names))
    schema = ", ".join(f"`{c}` {t}" for c, t in records.dtypes)
    decoded = placed.mapInArrow(_decode(model, ends), f"{schema}, _state int")
    unit = F.element_at(F.array(*[F.lit(n) for n in names]), F.col("_state") + 1)
    rest = records.where(~live).withColumn("unit", F.when(place >= 0, F.col(stated)).otherwise(F.lit(usual)))
    return decoded.withColumn("unit", unit).drop("_state").unionByName(rest)


def unit_named(text: Column) -> Column:
    """The unit that a text names, null if it names none. Mileage ('mil km') and denied dollars don't count."""
    t = F.translate(F.lower(text), "áéíóú", "aeiou")
    t = F.regexp_replace(F.regexp_replace(t, r"no se cotiza en dolares", " "), r"\d*\s*mil(es)?( de)? km\b", " ")
    dollars = t.rlike(r"u\$s|us\$|u\$d|\busd\b|\bdolar(es)?\b")
    thousand = t.rlike(r"\bmil(es)?\b|\d\s*k\b|\bk\b|\bk\$")
    million = t.rlike(r"\bmillon(es)?\b|\bmill\b|\bmm\b|\d\s*m\b")
    return (
        F.when(t.rlike(r"\bcentavos?\b|\bcent\b|\bcents\b"), "centavos").when(million, "millones").when(dollars & thousand, "kusd")
        .when(dollars, "usd").when(thousand, "miles").when(t.rlike(r"\$|\bars\b|\bpesos?\b"), "pesos")
    )


def amount_in(text: Column) -> Column:
    """The first amount of a text in local notation (1.234.567,89), as decimal; null if there is none."""
    digits = F.regexp_extract(text, r"\d{1,3}(?:\.\d{3})+(?!\d)(?:,\d+)?|\d+(?:,\d+)?", 0)
    return F.replace(F.replace(F.nullif(digits, F.lit("")), F.lit("."), F.lit("")), F.lit(","), F.lit(".")).try_cast("decimal(20,6)")


def in_pesos(amount: Column, unit: Column, rate: Column, units: Mapping[str, tuple[str, bool]] = UNITS) -> Column:
    """Whole pesos, halves rounded up; null without an amount, or without a rate for dollars."""
    out = F.lit(None).cast("decimal(38,6)")
    for name, (factor, dollars) in units.items():
        worth = amount.cast("decimal(18,6)") * F.lit(factor).cast("decimal(9,2)")
        if dollars:
            worth = worth.cast("decimal(20,4)") * rate.cast("decimal(12,6)")
        out = F.when(unit == name, worth.cast("decimal(38,6)")).otherwise(out)
    return F.round(out, 0).cast("long")


def rate_of_day(records: DataFrame, rates: DataFrame, day: str, fecha: str = "fecha", valor: str = "valor", name: str = "rate") -> DataFrame:
    """records with the rate of the last date up to `day`; null before the first one or without a day.

    Rates are spread over the days they hold (at most one row per calendar day), so the lookup is an equi join. Of
    several rates of one date the greatest counts; null ones are skipped.
    """
    one = rates.where(F.col(fecha).isNotNull() & F.col(valor).isNotNull()).groupBy(F.col(fecha).cast("date").alias("_from")).agg(F.max(valor).alias("_rate"))
    spans = one.withColumn("_next", F.lead("_from").over(W.orderBy("_from")))
    daily = spans.where("_next is not null").select(F.explode(F.sequence("_from", F.date_sub("_next", 1))).alias("_day"), "_rate")
    last = one.agg(F.max_by(F.struct("*"), "_from")).first()[0]
    out = records.withColumn("_day", F.col(day).cast("date")).join(daily, "_day", "left")
    if last:
        out = out.withColumn("_rate", F.when(F.col("_day") >= F.lit(last["_from"]), F.lit(last["_rate"])).otherwise(F.col("_rate")))
    return out.withColumn(name, F.col("_rate")).drop("_day", "_rate")


def guide_amounts(guide: DataFrame, rates: DataFrame) -> DataFrame:
    """registro_id, unit, pesos of cca_precios; the usual unit is thousands of pesos.

    The unit stands in unidad_original or behind the version. Rows delivered twice count once, rows without an amount or
    an id are left out.
    """
    behind = F.regexp_extract("version", r"([(\[].*|\s-\s.*|\scotiza .*)$", 1)
    rows = guide.where("registro_id is not null and precio_miles is not null").dropDuplicates(["registro_id"]).select(
        "registro_id", "periodo", F.upper(F.trim("marca")).alias("marca"), F.upper(F.trim("modelo")).alias("modelo"), "anio",
        F.upper(F.trim(F.regexp_replace("version", r"([(\[].*|\s-\s.*|\scotiza .*)$", ""))).alias("version"),
        F.col("precio_miles").cast("decimal(20,6)").alias("amount"),
        F.coalesce(unit_named(F.col("unidad_original")), unit_named(behind)).alias("said"),
    )
    rows = cut(rate_of_day(rows, rates, "periodo"))
    told = decode_units(rows, ["marca", "modelo", "version", "anio"], "periodo", "registro_id", "amount", "said", "rate", "miles", ["pesos", "millones"])
    return told.select("registro_id", "unit", in_pesos(F.col("amount"), F.col("unit"), F.col("rate")).alias("pesos"))


def service_amounts(service: DataFrame, rates: DataFrame) -> DataFrame:
    """registro_id, unit, only_text, pesos of service_precios; the usual unit is pesos.

    A unit in the text counts if the text gives the same number as precio, or alone; next moneda counts. Rows delivered
    twice count once, rows without any amount or an id are left out.
    """
    written, given = amount_in(F.col("precio_texto")), F.col("precio").cast("decimal(20,6)")
    by_text, by_field = unit_named(F.col("precio_texto")), unit_named(F.col("moneda"))
    strong = lambda u: F.when(u != "pesos", u)
    same = given.isNull() | (given == written)
    said = F.coalesce(F.when(same, strong(by_text)), strong(by_field), by_text, by_field)
    said = F.when(~same & (in_pesos(written, by_text, F.lit(None)) == given), "pesos").otherwise(said)
    rows = service.where("registro_id is not null").dropDuplicates(["registro_id"]).select(
        "registro_id", "capturado", "km", F.upper(F.trim("marca")).alias("marca"), F.upper(F.trim("modelo_fuente")).alias("modelo"),
        F.coalesce(given, written).alias("amount"), given.isNull().alias("only_text"), said.alias("said"),
    ).where("amount is not null")
    rows = cut(rate_of_day(rows, rates, "capturado"))
    told = decode_units(rows, ["marca", "modelo", "km"], "capturado", "registro_id", "amount", "said", "rate", "pesos", ["miles", "millones", "centavos"])
    return told.select(
        "registro_id", "unit", "only_text", in_pesos(F.col("amount"), F.col("unit"), F.col("rate")).alias("pesos")
    )
