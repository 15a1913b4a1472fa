"""Cost allocation: every charge is spread over shipments and adds up to the charge again.

A charge goes to the shipments of its warehouse, or to all shipments when it names none or
one without shipments. Shares follow the first usable basis of the charge type; amounts are
rounded by largest remainder. The mart has one row per charge and target by definition, so
the work is in keeping everything else off that grain:

* totals, row counts and usable bases are aggregated per scope from the shipments alone;
* floors and fractions depend on a target only through its basis value, so the cut-off
  fraction is found on the value histogram of each scope;
* ties at the cut-off go to the first targets in a fixed order, whose positions are numbered
  once per warehouse, not once per charge;
* so the mart is stored as factors, a row per charge (scope, basis, cut-off) and a row per
  target (basis values, positions), and expanded where single rows are asked for: a comparison of
  each target with its charge's cut-off, without a sort or window over charge-target rows;
* sums per item and store need no pairs either: what a target gets from a charge depends on its
  value alone, so counts per value are multiplied, and a basis that is 1 for all targets gives
  one more unit up to a position, so the targets of an item and store, which lie side by side, get
  the overlap of two intervals. Only ties at a cut-off are looked up line by line;
* sums per charge need no targets at all: they follow from the value histogram.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tideledger import config
from tideledger.operators.joins import is_small
from tideledger.operators.ranking import CUT_POINTS, ordered_position, weighted_cut
from tideledger.operators.staging import staged

# Bases that a target can carry, in the order in which they are summarised.
MEASURED = ["weight", "volume_cbm", "qty", "value"]
CONSTANT = ["order_count", "line_count", "revenue"]
BASES = MEASURED + CONSTANT
CHARGE = ["invoice_no", "invoice_line_no", "charge_type"]
EVERYWHERE = "__all_warehouses__"
# What sums show for a target without item or store.
ANY = "ALL"
SLICES = 64
# Positions that meet in one task where intervals are compared.
BUCKET = 65_536
# Charge-target pairs that are summed in one task, so that its memory does not grow with the data.
PIECE_PAIRS = 1_000_000
# Up to so many prices, counted after they are stored, are sent to all tasks.
PRICE_ROWS = 500_000
# Cut position of charges whose tied targets all get one unit more.
ALL_TIED = 2**62

COLUMNS = [
    "period", "charge_type", "charge_domain", "cost_stage", "invoice_no", "invoice_line_no",
    "item_id", "warehouse_id", "channel_store_id", "lot_id", "allocation_basis", "basis_value",
    "allocated_amount", "allocated_amount_krw", "currency", "capitalizable_flag",
]


def charge_policy(spark: SparkSession) -> DataFrame:
    """Policy rows with the basis priority of each charge type (18 rows)."""
    rows = [(*row, config.basis_priority(row[0])) for row in config.CHARGE_POLICY]
    return spark.createDataFrame(
        rows,
        "charge_type string, charge_domain string, cost_stage string, "
        "capitalizable_flag boolean, default_allocation_basis string, "
        "severity_if_missing string, basis_priority array<string>",
    )


def allocation_targets(shipment: DataFrame) -> DataFrame:
    """Shipment lines with every basis a charge can be spread by."""
    return shipment.select(
        "shipment_id", "item_id", "warehouse_id", "channel_store_id", "lot_id",
        F.col("weight").cast("double").alias("weight"),
        F.col("volume_cbm").cast("double").alias("volume_cbm"),
        F.col("qty_shipped").alias("qty"),
        F.col("qty_shipped").alias("value"),
        F.lit(1.0).alias("order_count"),
        F.lit(1.0).alias("line_count"),
        F.lit(1.0).alias("revenue"),
    )


def numbered_targets(targets: DataFrame) -> DataFrame:
    """Add each target's position within its warehouse and over all warehouses.

    Order: warehouse, store (NULL first), item, lot, shipment.
    """
    named = targets.withColumns(
        {
            "__store": F.when(F.col("channel_store_id").isNull(), F.lit("")).otherwise(
                F.concat(F.lit("s"), F.col("channel_store_id"))
            ),
            "__lot": F.coalesce("lot_id", F.lit("")),
        }
    )
    placed = ordered_position(
        named, ["warehouse_id"], ["__store", "item_id"], ["__lot", "shipment_id"], "position"
    ).drop("__store", "__lot")
    earlier = Window.orderBy("warehouse_id").rowsBetween(Window.unboundedPreceding, -1)
    # One row per warehouse reaches this window.
    starts = (
        targets.groupBy("warehouse_id")
        .agg(F.count(F.lit(1)).alias("n"))
        .select("warehouse_id", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("start"))
    )
    # Shipments without a warehouse are targets too. The stored size lets Spark send the rows to the targets,
    # which would otherwise meet in a task per warehouse.
    starts = staged(starts.withColumnRenamed("warehouse_id", "__of"), "warehouse-starts")
    return placed.join(starts, F.col("warehouse_id").eqNullSafe(F.col("__of"))).withColumn(
        "overall_position", F.col("start") + F.col("position")
    ).drop("start", "__of")


def scope_totals(targets: DataFrame) -> DataFrame:
    """Per warehouse, and over all of them: targets, basis totals and whether a basis is usable."""
    usable = {
        b: F.max((F.coalesce(F.col(b), F.lit(0.0)) != 0).cast("int")) for b in BASES
    }
    per_warehouse = targets.groupBy(F.col("warehouse_id").alias("scope")).agg(
        F.count(F.lit(1)).alias("targets"),
        *[F.sum(F.coalesce(F.col(b), F.lit(0.0))).alias(f"total_{b}") for b in BASES],
        *[usable[b].alias(f"usable_{b}") for b in BASES],
    )
    overall = per_warehouse.agg(
        F.sum("targets").alias("targets"),
        *[F.sum(f"total_{b}").alias(f"total_{b}") for b in BASES],
        *[F.max(f"usable_{b}").alias(f"usable_{b}") for b in BASES],
    ).select(F.lit(EVERYWHERE).alias("scope"), "*")
    return per_warehouse.unionByName(overall)


def _by_basis(make: Callable[[str], Column], bases: list[str] = BASES) -> Column:
    """Value that belongs to the row's resolved basis."""
    return reduce(
        lambda acc, b: acc.when(F.col("allocation_basis") == b, make(b)),
        bases[1:],
        F.when(F.col("allocation_basis") == bases[0], make(bases[0])),
    )


def scoped_charges(
    charge: DataFrame, exchange_rate: DataFrame, totals: DataFrame
) -> DataFrame:
    """Charges with policy, KRW rate, scope, resolved basis and the scope's totals.

    ``allocation_basis`` is NULL where no basis of the type's priority is usable. With no
    shipments at all, ``scope`` is NULL and the whole charge goes to one placeholder target.
    """
    policy = charge_policy(charge.sparkSession)
    rates = exchange_rate.select("period", "currency", "rate_to_krw")
    rate = F.when(F.col("currency") == "KRW", F.lit(1.0)).otherwise(
        F.coalesce("rate_to_krw", F.lit(1.0))
    )
    per_scope = totals.where(F.col("targets") > 0)
    known = per_scope.where(F.col("scope") != EVERYWHERE).select(
        F.col("scope").alias("warehouse_id"), F.lit(True).alias("__known")
    )
    usable = F.array_compact(
        F.array(*[F.when(F.col(f"usable_{b}") == 1, F.lit(b)) for b in BASES])
    )
    first_usable = F.try_element_at(
        F.filter("basis_priority", lambda b: F.array_contains(F.col("__usable"), b)), F.lit(1)
    )
    scope = F.when(F.col("__known"), F.col("warehouse_id")).otherwise(F.lit(EVERYWHERE))
    return (
        charge.select(*CHARGE, "period", "currency", "amount", "warehouse_id", "channel_store_id")
        .join(policy, "charge_type", "left")
        .join(rates, ["period", "currency"], "left")
        .join(known, "warehouse_id", "left")
        .withColumns({"rate": rate, "__scope": scope})
        .join(per_scope.withColumnRenamed("scope", "__scope"), "__scope", "left")
        .withColumn("scope", F.when(F.col("targets").isNotNull(), F.col("__scope")))
        # Without shipments the placeholder target carries every basis but the measured two.
        .withColumn(
            "__usable",
            F.when(F.col("scope").isNotNull(), usable).otherwise(
                F.array(*[F.lit(b) for b in ["qty", "value", *CONSTANT]])
            ),
        )
        .withColumn("allocation_basis", first_usable)
        .withColumn("total_basis", _by_basis(lambda b: F.col(f"total_{b}")))
        .drop("__usable", "__known", "__scope", "rate_to_krw", "basis_priority")
        .drop(*[f"total_{b}" for b in BASES], *[f"usable_{b}" for b in BASES])
    )


def unallocated_charges(
    charge: DataFrame, exchange_rate: DataFrame, shipment: DataFrame
) -> DataFrame:
    """Charges left out: no basis of their type can be measured, or the policy lacks the type."""
    totals = scope_totals(allocation_targets(shipment))
    return (
        scoped_charges(charge, exchange_rate, totals)
        .where(F.col("allocation_basis").isNull())
        .select(*CHARGE, "period", "currency", "amount", "charge_domain", "cost_stage")
    )


def share(value: Column, factor: int) -> Column:
    """Unrounded share of a target in rounding units."""
    proportional = value / F.col("total_basis") * F.col("amount")
    equal = F.col("amount") / F.col("targets")
    return F.when(F.col("total_basis") == 0, equal).otherwise(proportional) * F.lit(float(factor))


def _floor_and_rest(value: Column, factor: int) -> dict[str, Column]:
    units = share(value, factor)
    return {"floor": F.floor(units), "rest": units - F.floor(units)}


def used_bases(charges: DataFrame) -> list[tuple[str, bool]]:
    """The measured bases that charges use, each with whether over all warehouses: 8 pairs at most."""
    pairs = charges.where(F.col("allocation_basis").isin(MEASURED)).select(
        "allocation_basis", F.col("scope") == EVERYWHERE
    )
    return sorted((r[0], r[1]) for r in pairs.distinct().collect())


def value_counts(
    targets: DataFrame, used: list[tuple[str, bool]], by: list[str] = []
) -> DataFrame:
    """How often each value of a used basis occurs, per scope and ``by`` columns.

    The value 1 of the constant bases needs no counting: its count is the scope's size.
    """
    entries = [
        F.struct(
            (F.lit(EVERYWHERE) if everywhere else F.col("warehouse_id")).alias("scope"),
            F.lit(b).alias("allocation_basis"),
            F.coalesce(F.col(b), F.lit(0.0)).alias("basis_value"),
        )
        for b, everywhere in used or [(MEASURED[0], True)]
    ]
    targets = targets if used else targets.limit(0)
    return (
        targets.select(*by, F.explode(F.array(*entries)).alias("v"))
        .select(*by, "v.*")
        .groupBy("scope", "allocation_basis", "basis_value", *by)
        .agg(F.count(F.lit(1)).alias("n"))
    )


def charge_parts(charges: DataFrame, counts: DataFrame, factor: int) -> DataFrame:
    """Per charge and distinct basis value: how many targets, their floor and fraction."""
    constant = F.col("allocation_basis").isin(CONSTANT)
    measured = charges.where(~constant).join(counts, ["scope", "allocation_basis"])
    uniform = charges.where(constant).withColumns(
        {"basis_value": F.lit(1.0), "n": F.col("targets")}
    )
    return (
        measured.unionByName(uniform)
        .withColumns(_floor_and_rest(F.col("basis_value"), factor))
        .select(
            *CHARGE, "scope", "allocation_basis", "amount", "targets", "basis_value", "n",
            "floor", "rest", (-F.col("rest")).alias("minus_rest"),
        )
    )


def rounding(parts: DataFrame, factor: int) -> DataFrame:
    """Per charge: the sum of its targets' floors, and how many targets get one unit more."""
    missing = F.bround(F.col("amount") * F.lit(float(factor))) - F.col("floors")
    return (
        parts.groupBy(*CHARGE, "amount", "targets")
        .agg(F.sum(F.col("floor") * F.col("n")).alias("floors"))
        .withColumn(
            "extra",
            F.greatest(F.lit(0), F.least(missing.cast("bigint"), F.col("targets"))),
        )
    )


def charge_totals(
    charge: DataFrame,
    exchange_rate: DataFrame,
    shipment: DataFrame,
    decimals: int = config.ALLOCATION_DECIMALS,
) -> DataFrame:
    """What ``allocate_charges`` gives each charge in sum, and to how many targets.

    One row per allocated charge, from the counts of basis values alone: neither positions nor
    charge-target rows are made.
    """
    factor = 10**decimals
    targets = allocation_targets(shipment)
    charges = staged(
        scoped_charges(charge, exchange_rate, scope_totals(targets)).where(
            F.col("allocation_basis").isNotNull()
        ),
        "scoped-charges",
    )
    placed = charges.where(F.col("scope").isNotNull())
    parts = charge_parts(placed, value_counts(targets, used_bases(placed)), factor)
    spread = rounding(parts, factor).select(*CHARGE, (F.col("floors") + F.col("extra")).alias("units"))
    whole = F.bround(F.col("amount") * F.lit(float(factor)))
    units = F.when(F.col("scope").isNull(), whole).otherwise(F.col("units").cast("double"))
    return (
        charges.join(spread, CHARGE, "left")
        .withColumn("allocated_amount", units / F.lit(float(factor)))
        .select(
            "period", *CHARGE, "charge_domain", "cost_stage", "currency", "capitalizable_flag",
            F.coalesce("targets", F.lit(1)).cast("bigint").alias("targets"), "allocated_amount",
            (F.col("allocated_amount") * F.col("rate")).alias("allocated_amount_krw"),
        )
    )


def cut_parts(parts: DataFrame, factor: int) -> DataFrame:
    """``parts`` with the cut-off: ``cut_rest`` (NULL where no target gets more than its floor) and
    ``tied_extra``, the number of targets at the cut-off fraction that get one unit more.

    Most charges meet few distinct values, which one window orders; if a charge meets more than
    ``CUT_POINTS``, the cut is searched by refined histograms instead.
    """
    whole = Window.partitionBy(*CHARGE)
    missing = F.bround(F.col("amount") * F.lit(float(factor))) - F.sum(F.col("floor") * F.col("n")).over(whole)
    extra = F.greatest(F.lit(0), F.least(missing.cast("bigint"), F.col("targets")))
    most = parts.groupBy(*CHARGE).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0]
    if (most or 0) > CUT_POINTS:
        wanted = rounding(parts, factor).where(F.col("extra") > 0).select(*CHARGE, "extra")
        cut = weighted_cut(parts, CHARGE, "minus_rest", "n", wanted, "extra", "cut", "before").select(
            *CHARGE, (-F.col("cut")).alias("cut_rest"), (F.col("extra") - F.col("before")).alias("tied_extra")
        )
        return parts.join(cut, CHARGE, "left")
    # Targets above a row's fraction, and those with it.
    through = F.sum("n").over(whole.orderBy("minus_rest").rangeBetween(Window.unboundedPreceding, Window.currentRow))
    same = F.sum("n").over(Window.partitionBy(*CHARGE, "minus_rest"))
    holds = (F.col("through") - F.col("same") < F.col("extra")) & (F.col("extra") <= F.col("through"))
    return (
        parts.withColumns({"extra": extra, "through": through, "same": same})
        .withColumn("__cut", F.when(holds, F.struct(
            F.col("rest").alias("rest"), (F.col("extra") - F.col("through") + F.col("same")).alias("tied"))))
        .withColumn("__cut", F.max("__cut").over(whole))
        .withColumns({"cut_rest": F.col("__cut.rest"), "tied_extra": F.col("__cut.tied")})
        .drop("extra", "through", "same", "__cut")
    )


def cut_positions(parts: DataFrame, targets: DataFrame) -> DataFrame:
    """Per charge whose tied targets do not all get a unit, the position up to which they do.

    Few fractions are equal for different basis values, so few targets are looked at.
    """
    tied = parts.where(F.col("rest") == F.col("cut_rest"))
    in_charge = Window.partitionBy(*CHARGE)
    contested = staged(
        tied.withColumn("tied", F.sum("n").over(in_charge))
        .where(~F.col("allocation_basis").isin(CONSTANT) & (F.col("tied") > F.col("tied_extra")))
        .select(*CHARGE, "scope", "allocation_basis", "basis_value", "tied_extra", "tied"),
        "contested-charges",
    )
    used = used_bases(contested)
    if not used:
        return contested.select(*CHARGE, F.lit(0).cast("bigint").alias("cut_position"))
    lines = stacked_positions(targets, used)
    side = F.broadcast(contested) if is_small(contested) else contested
    rivals = lines.join(side, ["scope", "allocation_basis", "basis_value"])
    if contested.agg(F.max("tied")).first()[0] <= CUT_POINTS:
        place = F.row_number().over(in_charge.orderBy("spot"))
        return rivals.withColumn("place", place).where(F.col("place") == F.col("tied_extra")).select(
            *CHARGE, F.col("spot").alias("cut_position")
        )
    limits = contested.select(*CHARGE, "tied_extra").distinct()
    rivals = rivals.select(*CHARGE, "spot", F.lit(1).alias("one"))
    return weighted_cut(
        rivals, CHARGE, "spot", "one", limits, "tied_extra", "cut_position", "passed"
    ).select(*CHARGE, "cut_position")


def stacked_positions(
    targets: DataFrame, used: list[tuple[str, bool]], by: list[str] = []
) -> DataFrame:
    """Target positions by scope, basis and value, for looking up ties."""
    entries = [
        F.struct(
            (F.lit(EVERYWHERE) if everywhere else F.col("warehouse_id")).alias("scope"),
            F.lit(b).alias("allocation_basis"),
            F.coalesce(F.col(b), F.lit(0.0)).alias("basis_value"),
            F.col("overall_position" if everywhere else "position").alias("spot"),
        )
        for b, everywhere in used or [(MEASURED[0], True)]
    ]
    targets = targets if used else targets.limit(0)
    return targets.select(*by, F.explode(F.array(*entries)).alias("e")).select(*by, "e.*")


@dataclass(frozen=True)
class Spread:
    """The allocation as factors: nothing in it has a row per charge and target.

    ``charges``: a row per allocated charge with its scope, basis, the scope's totals, and the cut-off
    (NULL where no target gets more than its floor). ``parts``: a row per charge and distinct basis
    value, with the targets of that value, what each gets, and whether a tie is open among them.
    ``targets``: a row per shipment line with its basis values and positions. ``factor``: rounding
    units per currency unit.
    """

    charges: DataFrame
    parts: DataFrame
    targets: DataFrame
    factor: int


def spread_charges(
    charge: DataFrame,
    exchange_rate: DataFrame,
    shipment: DataFrame,
    decimals: int = config.ALLOCATION_DECIMALS,
) -> Spread:
    """Decide, per charge, what each of its targets gets."""
    factor = 10**decimals
    lines = allocation_targets(shipment)
    with ThreadPoolExecutor(1) as beside:
        # Nothing before the ties needs positions, so targets are numbered meanwhile.
        numbering = beside.submit(
            inheritable_thread_target(charge.sparkSession)(
                lambda: staged(numbered_targets(lines), "allocation-targets")
            )
        )
        charges = staged(
            scoped_charges(charge, exchange_rate, scope_totals(lines)).where(
                F.col("allocation_basis").isNotNull()
            ),
            "scoped-charges",
        )
        placed = charges.where(F.col("scope").isNotNull())
        counts = value_counts(lines, used_bases(placed))
        # The windows of the cut-off read what was stored, not the join above it.
        parts = staged(charge_parts(placed, counts, factor), "charge-parts")
        parts = staged(cut_parts(parts, factor), "cut-parts")
        targets = numbering.result()
    return Spread(*located(charges, parts, targets), targets, factor)


def located(charges: DataFrame, parts: DataFrame, targets: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``charges`` and ``parts`` with the position up to which tied targets get one unit more."""
    searched = staged(cut_positions(parts, targets), "cut-positions")
    tied = F.col("rest") == F.col("cut_rest")
    constant = F.col("allocation_basis").isin(CONSTANT)
    # A constant basis ties all targets of the scope; without a search, all tied ones get a unit.
    last = F.when(constant, F.col("tied_extra")).otherwise(F.coalesce("cut_position", F.lit(ALL_TIED)))
    side = F.broadcast(searched) if is_small(searched) else searched
    parts = (
        parts.join(side, CHARGE, "left")
        .withColumn("cut_position", F.when(F.col("cut_rest").isNotNull(), last))
        .withColumn("open_tie", tied & (F.col("cut_position") < ALL_TIED))
        .withColumn("units", F.col("floor") + F.when(
            (F.col("rest") > F.col("cut_rest")) | (tied & (F.col("cut_position") == ALL_TIED)), 1
        ).otherwise(0))
        .drop("minus_rest", "tied_extra")
    )
    cuts = parts.groupBy(*CHARGE).agg(
        F.max("cut_rest").alias("cut_rest"), F.max("cut_position").alias("cut_position")
    )
    return staged(charges.join(cuts, CHARGE, "left"), "charge-factors"), parts


def allocate_charges(
    charge: DataFrame,
    exchange_rate: DataFrame,
    shipment: DataFrame,
    decimals: int = config.ALLOCATION_DECIMALS,
    slices: int | None = None,
) -> DataFrame:
    """One row per charge and target shipment line, adding up to the rounded charge."""
    return expanded(spread_charges(charge, exchange_rate, shipment, decimals), slices)


def _units(value: Column, factor: int, spot: Column) -> Column:
    """Rounding units that a target of this basis value and position gets."""
    parts = _floor_and_rest(value, factor)
    rest, cut = parts["rest"], F.col("cut_rest")
    bumped = (rest > cut) | ((rest == cut) & (spot <= F.col("cut_position")))
    return parts["floor"] + F.when(bumped, F.lit(1)).otherwise(F.lit(0))


def expanded(spread: Spread, slices: int | None = None) -> DataFrame:
    """The allocation as rows, one per charge and target."""
    targets, factor = spread.targets, spread.factor
    placed = spread.charges.where(F.col("scope").isNotNull())
    # Charges are few and shipments many: as long as a count proves it, the charges are
    # broadcast and no shipment moves. Otherwise each charge is repeated per slice, so that one
    # warehouse's shipments, and a charge on all of them, spread over many tasks.
    few = slices is None and is_small(placed)
    slices = 1 if few else slices or SLICES
    ready = placed.drop("warehouse_id", "channel_store_id").withColumn(
        "slice", F.explode(F.sequence(F.lit(0), F.lit(slices - 1)))
    )
    side = F.broadcast if few else (lambda df: df)
    sliced = targets.withColumn(
        "slice", F.pmod(F.xxhash64("shipment_id", "item_id", "lot_id"), F.lit(slices)).cast("int")
    )
    local = (
        sliced.withColumn("scope", F.col("warehouse_id"))
        .withColumn("spot", F.col("position"))
        .join(side(ready.where(F.col("scope") != EVERYWHERE)), ["scope", "slice"])
    )
    wide = sliced.withColumn("spot", F.col("overall_position")).join(
        side(ready.where(F.col("scope") == EVERYWHERE)), "slice"
    )
    pairs = local.unionByName(wide).withColumn(
        "basis_value", _by_basis(lambda b: F.coalesce(F.col(b), F.lit(0.0)))
    )
    units = _units(F.col("basis_value"), factor, F.col("spot"))
    rows = pairs.withColumn("allocated_amount", units.cast("double") / F.lit(float(factor)))
    krw = F.col("allocated_amount") * F.col("rate")
    return (
        rows.unionByName(whole_charges(spread), allowMissingColumns=True)
        .withColumn("allocated_amount_krw", krw)
        .select(*COLUMNS)
    )


def expansion_sql(charges: str, targets: str, factor: int) -> str:
    """``expanded`` as SQL over the stored factors, for a view: the tables hold a row per charge and
    a row per target, and the view's plan is the join of both where it is read."""
    value = "CASE allocation_basis " + " ".join(
        f"WHEN '{b}' THEN coalesce(t.{b}, 0D)" for b in BASES
    ) + " END"
    share_of_total = f"CASE WHEN total_basis = 0 THEN amount / targets ELSE basis_value / total_basis * amount END * {factor}D"
    mart_columns = ", ".join(COLUMNS[:COLUMNS.index("allocated_amount")])
    target = "t.item_id, t.warehouse_id, t.channel_store_id, t.lot_id"
    slice_of = f"pmod(xxhash64(t.shipment_id, t.item_id, t.lot_id), {SLICES})"
    of_charge = ("c.period, c.charge_type, c.charge_domain, c.cost_stage, c.invoice_no, c.invoice_line_no, "
                 "c.allocation_basis, c.currency, c.capitalizable_flag, c.amount, c.targets, "
                 "c.total_basis, c.rate, c.cut_rest, c.cut_position")
    last = "allocated_amount, allocated_amount * rate AS allocated_amount_krw, currency, capitalizable_flag"
    return f"""
        WITH sliced AS (
            SELECT *, explode(sequence(0, {SLICES - 1})) AS slice FROM {charges} WHERE scope IS NOT NULL
        ), pairs AS (
            SELECT {of_charge}, {target}, t.position AS spot, {value} AS basis_value
            FROM {targets} t JOIN sliced c ON c.scope = t.warehouse_id AND c.slice = {slice_of}
            UNION ALL
            SELECT {of_charge}, {target}, t.overall_position AS spot, {value} AS basis_value
            FROM {targets} t JOIN sliced c ON c.slice = {slice_of} WHERE c.scope = '{EVERYWHERE}'
        ), shares AS (
            SELECT *, {share_of_total} AS raw FROM pairs
        ), rounded AS (
            SELECT *, CAST(floor(raw) + CASE
                WHEN raw - floor(raw) > cut_rest
                     OR (raw - floor(raw) = cut_rest AND spot <= cut_position) THEN 1 ELSE 0
                END AS DOUBLE) / {factor}D AS allocated_amount
            FROM shares
        ), whole AS (
            SELECT *, bround(amount * {factor}D) / {factor}D AS allocated_amount
            FROM {charges} WHERE scope IS NULL
        )
        SELECT {mart_columns}, {last} FROM rounded
        UNION ALL
        SELECT period, charge_type, charge_domain, cost_stage, invoice_no, invoice_line_no,
               'UNALLOCATED', coalesce(warehouse_id, 'UNKNOWN'), coalesce(channel_store_id, 'UNKNOWN'),
               '{config.NO_LOT}', allocation_basis, 1D, {last}
        FROM whole"""


def whole_charges(spread: Spread) -> DataFrame:
    """Charges without any target, each on one placeholder."""
    units = _whole_units(spread.factor)
    return spread.charges.where(F.col("scope").isNull()).withColumns(
        {
            "item_id": F.lit("UNALLOCATED"),
            "warehouse_id": F.coalesce("warehouse_id", F.lit("UNKNOWN")),
            "channel_store_id": F.coalesce("channel_store_id", F.lit("UNKNOWN")),
            "lot_id": F.lit(config.NO_LOT),
            "basis_value": F.lit(1.0),
            "allocated_amount": units / F.lit(float(spread.factor)),
        }
    )


def _whole_units(factor: int) -> Column:
    return F.bround(F.col("amount") * F.lit(float(factor)))


def allocated_sums(
    spread: Spread, charge_keys: list[str], target_keys: list[str], only: DataFrame | None = None
) -> DataFrame:
    """``charge_keys`` x ``target_keys``: number of targets and their amounts, from the factors.

    ``target_keys`` are columns of (item_id, channel_store_id), or none for sums over all targets.
    Charges of equal keys, scope and rate are added up before they meet targets. ``only`` has
    rows of both keys: then targets meet the prices of the charges asked for and no others, and a
    NULL target key goes by ``ANY``.
    """
    factor, targets = spread.factor, spread.targets
    named = spread.charges.select(*CHARGE, *_new([*charge_keys, "rate"]))
    parts = spread.parts.join(F.broadcast(named) if is_small(named) else named, CHARGE)
    card = [*charge_keys, "rate"]
    constant = F.col("allocation_basis").isin(CONSTANT)
    open_ties = parts.where(F.col("open_tie"))

    # What targets of a value, at a place or in a tie get from all charges of a card together.
    prices = (
        _value_prices(parts.where(~constant), card)
        .unionByName(bucketed(_steps(parts.where(constant), card), "place"))
        .unionByName(_tie_prices(open_ties, card))
    )
    if only is not None:
        asked = only.select(*charge_keys, *target_keys).na.drop()
        prices = prices.join(F.broadcast(asked.select(*charge_keys).distinct()), charge_keys, "left_semi")
    prices = staged(prices, "prices")
    # One look at the parts: the bases to count.
    basis = F.when(~constant, F.struct("allocation_basis", F.col("scope") == EVERYWHERE))
    about = spread.parts.agg(F.collect_set(basis), F.collect_set(F.when(F.col("open_tie"), basis))).first()
    used, tied = ([tuple(b) for b in about[i]] for i in (0, 1))
    lots = target_lots(targets, used, target_keys)
    places, pieces = target_keys, 0
    if target_keys:
        # Targets move once, to where their sums are made, in pieces of a bounded number of pairs.
        pairs = spread.charges.where(F.col("scope").isNotNull()).agg(F.sum("targets")).first()[0] or 0
        pieces = max(
            int(targets.sparkSession.conf.get("spark.sql.shuffle.partitions")), pairs // PIECE_PAIRS + 1
        )
        if only is not None:
            # Runs are of the keys as they are, since ``ANY`` may be the name of one, too.
            named = {f"__{k}": F.coalesce(k, F.lit(ANY)) for k in target_keys}
            lots, targets, places = lots.withColumns(named), targets.withColumns(named), list(named)
        lots = lots.repartition(pieces, *places)
    entries = _value_entries(lots, used, places).unionByName(bucketed(_runs(lots, places), "place"))
    if tied:
        ties = _tie_entries(open_ties, targets, tied, places)
        entries = entries.unionByName(ties.repartition(pieces, *places) if places else ties)
    entries = entries.withColumnsRenamed(dict(zip(places, target_keys)))
    on = ["scope", "kind", "at"]
    wanted = F.lit(True)
    near = is_small(prices, PRICE_ROWS)
    if near:
        # Then no product of prices and targets is shuffled.
        prices = F.broadcast(prices)
    if only is not None and near:
        # The keys asked for come as one list per target, so targets are not repeated for each.
        key = F.col(charge_keys[0]) if len(charge_keys) == 1 else F.struct(*charge_keys)
        lists = asked.repartition(pieces, *target_keys).groupBy(*target_keys).agg(
            F.collect_set(key).alias("__asked")
        )
        entries = entries.join(lists, target_keys)
        wanted = F.array_contains("__asked", key)
    elif only is not None:
        entries = entries.join(asked.repartition(pieces, *target_keys).distinct(), target_keys)
        on = [*on, *charge_keys]
    begin = F.greatest("__lo", "lo")
    n = F.least("__hi", "hi") - begin
    once = (F.col("kind") != "place") | (F.floor(begin / BUCKET) == F.col("at"))
    amount = F.col("units").cast("double") / F.lit(float(factor))
    spread_out = (
        entries.withColumnsRenamed({"lo": "__lo", "hi": "__hi"})
        .join(prices, on)
        .where((n > 0) & once & wanted)
        .select(*card, *target_keys, (n * F.col("charges")).alias("targets"), (n * F.col("units")).alias("units"))
    )
    # Only with no shipment at all is a charge whole, so no key is on both sides.
    whole = whole_charges(spread).select(
        *card, *target_keys, F.lit(1).cast("bigint").alias("targets"),
        _whole_units(factor).cast("bigint").alias("units"),
    )
    return reduce(DataFrame.unionByName, [
        side.groupBy(*charge_keys, *target_keys).agg(
            F.sum("targets").alias("targets"), F.sum(amount).alias("allocated_amount"),
            F.sum(amount * F.col("rate")).alias("allocated_amount_krw"),
        )
        for side in (spread_out, whole)
    ])


def _value_prices(parts: DataFrame, card: list[str]) -> DataFrame:
    return parts.groupBy(
        *card, "scope", F.col("allocation_basis").alias("kind"), F.col("basis_value").alias("at")
    ).agg(F.sum("units").alias("units"), F.count(F.lit(1)).alias("charges")).withColumns(any_count())


def target_lots(targets: DataFrame, used: list[tuple[str, bool]], target_keys: list[str]) -> DataFrame:
    """Targets of one place with equal values of the used bases as one row: all that sums need of them."""
    bases = sorted({b for b, _ in used})
    return targets.groupBy(
        *_side_by_side(target_keys), *[F.coalesce(F.col(b), F.lit(0.0)).alias(b) for b in bases]
    ).agg(
        F.count(F.lit(1)).alias("n"), F.min("position").alias("own"),
        F.min("overall_position").alias("overall"),
    )


def _side_by_side(target_keys: list[str]) -> list[str]:
    """Targets that agree on these lie side by side."""
    return ["warehouse_id", *(["channel_store_id", "item_id"] if target_keys else [])]


def _value_entries(lots: DataFrame, used: list[tuple[str, bool]], target_keys: list[str]) -> DataFrame:
    """How many targets have a value: [0, n), for each lot on its own."""
    entries = [
        F.struct(
            (F.lit(EVERYWHERE) if everywhere else F.col("warehouse_id")).alias("scope"),
            F.lit(b).alias("kind"),
            F.col(b).alias("at"),
        )
        for b, everywhere in used
    ] or [F.struct(*[F.lit(None).cast(t).alias(c) for c, t in (
        ("scope", "string"), ("kind", "string"), ("at", "double"))])]
    return (
        lots.select(*target_keys, "n", F.explode(F.array(*entries)).alias("v"))
        .select(*target_keys, "v.*", F.lit(0).cast("bigint").alias("lo"), F.col("n").alias("hi"))
        .where(F.col("kind").isNotNull())
    )


def any_count() -> dict[str, Column]:
    """An interval that holds every [0, n)."""
    return {"lo": F.lit(0).cast("bigint"), "hi": F.lit(2**62).cast("bigint")}


def bucketed(spans: DataFrame, kind: str) -> DataFrame:
    """Intervals, once for each bucket of positions that they meet."""
    first, last = (F.floor(c / BUCKET).cast("bigint") for c in (F.col("lo"), F.col("hi") - 1))
    return spans.where(F.col("lo") < F.col("hi")).select(
        "*", F.lit(kind).alias("kind"), F.explode(F.sequence(first, last).cast("array<double>")).alias("at")
    )


def _tie(of: list[str]) -> Column:
    return F.concat_ws("/", F.lit("tie"), *of)


def _tie_prices(ties: DataFrame, card: list[str]) -> DataFrame:
    """One unit more, on top of what the value gets."""
    return ties.select(*CHARGE, *_new(card), "scope").distinct().select(
        *card, "scope", _tie(CHARGE).alias("kind"), F.lit(0.0).alias("at"),
        F.lit(1).cast("bigint").alias("units"), F.lit(0).cast("bigint").alias("charges"),
    ).withColumns(any_count())


def _tie_entries(
    ties: DataFrame, targets: DataFrame, used: list[tuple[str, bool]], target_keys: list[str]
) -> DataFrame:
    """How many targets a contested tie reaches, counted line by line."""
    # A row per charge at most for each value at its cut; where they are few, no line moves to them.
    ties = staged(ties.select(*CHARGE, "scope", "allocation_basis", "basis_value", "cut_position"), "open-ties")
    ties = F.broadcast(ties) if is_small(ties) else ties
    lines = stacked_positions(targets, used, target_keys)
    return (
        lines.join(ties, ["scope", "allocation_basis", "basis_value"])
        .where(F.col("spot") <= F.col("cut_position"))
        .groupBy(*target_keys, "scope", _tie(CHARGE).alias("kind"))
        .agg(F.count(F.lit(1)).alias("hi"))
        .select(*target_keys, "scope", "kind", F.lit(0.0).alias("at"),
                F.lit(0).cast("bigint").alias("lo"), "hi")
    )


def _new(columns: list[str]) -> list[str]:
    """Columns that the parts of a charge do not have yet."""
    return [c for c in columns if c not in (*CHARGE, "scope", "allocation_basis", "amount", "targets")]


def _steps(parts: DataFrame, card: list[str]) -> DataFrame:
    """Per scope and card of charges on constant bases: [lo, hi) of positions from 0, and what all of
    its charges together give each target there."""
    cut = F.least(F.coalesce("cut_position", F.lit(0)), F.col("targets"))
    knots = parts.groupBy("scope", *card, "targets", cut.alias("cut")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("floor").alias("floor")
    )
    # A card has as many knots as charges at most; shipments are not among them.
    whole = Window.partitionBy("scope", *card)
    onward = whole.orderBy("cut").rowsBetween(Window.currentRow, Window.unboundedFollowing)
    before = whole.orderBy("cut")
    cuts = knots.withColumns(
        {
            "lo": F.coalesce(F.lag("cut").over(before), F.lit(0)).cast("bigint"),
            "more": F.sum("n").over(onward),
            "floor": F.sum("floor").over(whole),
            "charges": F.sum("n").over(whole),
            "last": F.max("cut").over(whole),
        }
    )
    # Below a cut, the charges cut there or further on give one more; beyond the last, none does.
    ends = F.array(
        F.struct(F.col("lo"), F.col("cut").cast("bigint").alias("hi"), "more"),
        F.struct(
            F.col("cut").cast("bigint").alias("lo"),
            F.when(F.col("cut") == F.col("last"), F.col("targets")).otherwise(F.col("cut"))
            .cast("bigint").alias("hi"),
            F.lit(0).cast("bigint").alias("more"),
        ),
    )
    return cuts.select("scope", *card, "floor", "charges", F.explode(ends).alias("e")).select(
        "scope", *card, "e.lo", "e.hi", "charges", (F.col("floor") + F.col("e.more")).alias("units")
    )


def _runs(lots: DataFrame, target_keys: list[str]) -> DataFrame:
    """Targets that lie side by side, as [lo, hi) of positions from 0, per scope."""
    runs = lots.groupBy(*dict.fromkeys([*_side_by_side(target_keys), *target_keys])).agg(
        F.sum("n").alias("n"), F.min("own").alias("own"), F.min("overall").alias("overall"),
    )
    spots = F.array(
        F.struct(F.col("warehouse_id").alias("scope"), (F.col("own") - 1).alias("lo")),
        F.struct(F.lit(EVERYWHERE).alias("scope"), (F.col("overall") - 1).alias("lo")),
    )
    return runs.select(*target_keys, "n", F.explode(spots).alias("s")).select(
        *target_keys, "s.scope", "s.lo", (F.col("s.lo") + F.col("n")).alias("hi")
    )


def spread_totals(spread: Spread) -> DataFrame:
    """What stored factors give each charge in sum: the columns of ``charge_totals``."""
    keys = ["period", *CHARGE, "charge_domain", "cost_stage", "currency", "capitalizable_flag"]
    return allocated_sums(spread, keys, [])


def largest_remainder(amounts: DataFrame, group: list[str], order: str, raw: str, total: str,
                      decimals: int = 0) -> DataFrame:
    """Round ``raw`` within small groups so that each adds up to its rounded ``total``.

    The direct form: one window per group. Used where groups are known to be small and as the
    yardstick for ``allocate_charges``.
    """
    factor = float(10**decimals)
    units = F.col(raw) * F.lit(factor)
    w = Window.partitionBy(*group)
    ranked = w.orderBy(F.desc("__rest"), F.asc(order))
    return (
        amounts.withColumn("__floor", F.floor(units))
        .withColumn("__rest", units - F.col("__floor"))
        .withColumn(
            "__extra", F.bround(F.col(total) * F.lit(factor)) - F.sum("__floor").over(w)
        )
        .withColumn(
            "rounded",
            (
                F.col("__floor")
                + F.when(F.row_number().over(ranked) <= F.col("__extra"), 1).otherwise(0)
            )
            / F.lit(factor),
        )
        .drop("__floor", "__rest", "__extra")
    )
