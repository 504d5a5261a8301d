"""End-to-end build: bronze -> silver -> gold, written parents first, then
reconciled. Each table is written to the shared folder and read back, so
later stages start from storage rather than recomputing the lineage."""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tessera.operators import gold as G
from tessera.operators.quality import assert_keys, assert_reconciled, reconcile_layers, reconcile_rows
from tessera.plans.profiling import CONSTRAINT_REPORTS
from tessera.plans.tables import GOLD_INPUTS, SILVER_INPUTS
from tessera.session import shuffles_freed, side_by_side
from tessera.sources.schemas import GOLD_ORDER, SCHEMAS, SILVER_ORDER
from tessera.sources.sinks import publish_run, register_tables, stage_table, write_table

# fact tables are clustered on the purchase date (pruning for date filters)
# (an order's lines stay together: they share its long keys)
SORT_BY = {"fact_order": ["purchase_date_key"], "fact_order_item": ["purchase_date_key", "order_id"],
           "orders": ["purchased_at"], "order_items": ["order_id"]}


def land_bronze(bronze: dict[str, DataFrame], base: str,
                timings: dict[str, float] | None = None) -> dict[str, DataFrame]:
    """Write the (all-string) bronze tables as they arrive and read them
    back: profiling and silver then scan landed files instead of
    re-deriving the sources. A re-land that would reshape a table fails."""
    landed = {}
    for name, df in bronze.items():
        t0 = time.time()
        landed[name] = write_table(df, f"{base}/bronze/{name}", schema=df.schema)
        if timings is not None:
            timings[f"bronze_{name}"] = time.time() - t0
    return landed


def build_silver_layer(bronze: dict[str, DataFrame], base: str, staged: dict[str, str],
                       timings: dict[str, float] | None = None, wanted: set[str] | None = None) -> dict[str, DataFrame]:
    """New, unpublished versions (of the ``wanted`` tables), a few written at once; ``staged`` gets path -> version."""
    names = [n for n in SILVER_ORDER if wanted is None or n in wanted]

    def job(name: str):
        fn, inputs = SILVER_INPUTS[name]
        return lambda _: _staged(lambda: fn(*[bronze[b] for b in inputs]), f"{base}/silver/{name}", name, timings, f"stg_{name}")

    spark = next(iter(bronze.values())).sparkSession
    return _side_by_side(spark, {n: job(n) for n in names}, base, "silver", staged)


def _staged(build: Callable[[], DataFrame], path: str, name: str, timings: dict[str, float] | None, label: str) -> tuple[DataFrame, str]:
    t0 = time.time()
    out = stage_table(build(), path, schema=SCHEMAS[name], table=name, sort_by=SORT_BY.get(name))
    if timings is not None:
        timings[label] = time.time() - t0
    return out


def _side_by_side(spark: SparkSession, jobs: dict, base: str, layer: str, staged: dict[str, str], after: dict | None = None) -> dict[str, DataFrame]:
    with shuffles_freed(spark):
        done = side_by_side(spark, jobs, after)
    staged |= {f"{base}/{layer}/{n}": version for n, (_, version) in done.items()}
    return {n: df for n, (df, _) in done.items()}


def build_gold_layer(silver: dict[str, DataFrame], base: str, staged: dict[str, str], timings: dict[str, float] | None = None,
                     wanted: set[str] | None = None, known: dict[str, DataFrame] | None = None) -> dict[str, DataFrame]:
    """As ``build_silver_layer``; ``known`` gold tables were written before."""
    s = silver
    builders = {
        "dim_date": lambda g: G.build_dim_date(s["orders"]),
        "dim_product": lambda g: G.build_dim_product(s["products"], s["product_categories"]),
        "dim_seller": lambda g: G.build_dim_seller(s["sellers"], s["geography"]),
        "fact_order": lambda g: G.build_fact_order(s["orders"], s["customers"], s["order_items"],
                                                   s["order_payments"], s["order_reviews"], s["reviews"]),
        # reads fact_order back from storage: it is not computed twice
        "dim_customer": lambda g: G.build_dim_customer(s["customers"], s["orders"], s["geography"],
                                                       g["fact_order"]),
        "fact_order_item": lambda g: G.build_fact_order_item(s["order_items"], s["orders"], s["customers"]),
        "dim_customer_history": lambda g: G.build_dim_customer_history(s["customers"], s["orders"]),
    }
    names = [n for n in GOLD_ORDER if wanted is None or n in wanted]

    def job(name: str):
        return lambda done: _staged(lambda: builders[name]((known or {}) | {n: df for n, (df, _) in done.items()}), f"{base}/gold/{name}", name, timings, name)

    return _side_by_side(next(iter(s.values())).sparkSession, {n: job(n) for n in names}, base, "gold", staged, {"dim_customer": ("fact_order",)})


def with_inputs(names: set[str]) -> set[str]:
    """Silver and gold tables, and those that they are built from."""
    out = set(names)
    while more := {i.split(":")[1] for n in out & GOLD_INPUTS.keys() for i in GOLD_INPUTS[n][1]} - out:
        out |= more
    return out


def build_tables(bronze: dict[str, DataFrame], base: str, names: set[str], known: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Write some tables, and what they are built from, as a run of their own; tables that are ``known`` are written already
    and are read. Returns the new ones."""
    wanted = with_inputs(names) - known.keys()
    if not wanted:
        return {}
    staged: dict[str, str] = {}
    silver = build_silver_layer(bronze, base, staged, wanted=wanted)
    gold = build_gold_layer(known | silver, base, staged, wanted=wanted, known=known)
    publish_run(next(iter(bronze.values())).sparkSession, base, staged)
    return silver | gold


def run_pipeline(bronze: dict[str, DataFrame], base: str, reconcile: bool = True, check_keys: bool = True,
                 register: bool = False,
                 timings: dict[str, float] | None = None) -> tuple[dict[str, DataFrame], dict[str, DataFrame]]:
    """Write new versions of silver and gold under ``base``, check them, then publish them all
    by one row group of the log of runs: readers see all of the new versions or none. The run fails, and readers keep the versions they had, if the layers disagree
    (item value and revenue totals), or, with ``check_keys``, if any of the
    primary keys is duplicated/NULL or any of the foreign keys has
    orphans. ``register`` exposes the
    published tables as ``silver.*`` / ``gold.*`` in the catalog."""
    staged: dict[str, str] = {}
    silver = build_silver_layer(bronze, base, staged, timings)
    gold = build_gold_layer(silver, base, staged, timings)
    spark = next(iter(gold.values())).sparkSession
    t0 = time.time()
    if reconcile:
        assert_reconciled(reconcile_layers(silver, gold))
        assert_reconciled(reconcile_rows(silver, gold))
    if check_keys:
        both = {**silver, **gold}
        assert_keys(CONSTRAINT_REPORTS["dq_pk_violations"](both), CONSTRAINT_REPORTS["dq_fk_violations"](both))
    if timings is not None:
        timings["checks"] = time.time() - t0
    publish_run(spark, base, staged)
    if register:  # silver.<table> and gold.<table> in the session catalog
        register_tables(spark, "silver", {n: f"{base}/silver/{n}" for n in silver})
        register_tables(spark, "gold", {n: f"{base}/gold/{n}" for n in gold})
    return silver, gold
