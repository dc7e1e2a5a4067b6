"""Summarise the final (post-AQE) physical plan of every registered query.

Usage: python tools/plan_report.py [sf_dir] > PLANS.md
Each query is executed once, then its adaptive plan is read back from
``explain("formatted")`` and reduced to: shuffles, broadcasts, join strategies,
aggregate operators, top-k / window operators and the columns read per table.
"""

from __future__ import annotations

import io
import re
import sys
from contextlib import redirect_stdout
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from mercato.registry import QUERIES  # noqa: E402
from mercato.session import build_session  # noqa: E402


def formatted(df) -> str:
    buf = io.StringIO()
    with redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def summarise(text: str) -> dict[str, str]:
    tree = text.split("\n\n")[0].split("== Initial Plan ==")[0]
    nodes = re.findall(r"([A-Za-z]+(?: [A-Za-z]+)*) \(\d+\)", tree)
    count = lambda n: sum(1 for x in nodes if x == n)
    joins = [x for x in nodes if x.endswith("Join") or "Join " in x]
    aggs = [x for x in nodes if x.endswith("Aggregate")]
    scans = {}
    for loc, schema in re.findall(r"Location: InMemoryFileIndex \[file:[^\]]*/([a-z_]+)\.parquet\]\n"
                                  r"(?:.*\n)*?ReadSchema: struct<([^>]*)>", text):
        cols = [c.split(":")[0] for c in schema.split(",") if c]
        scans[loc] = max(scans.get(loc, []), cols, key=len)  # widest scan of the table
    return {
        "shuffles": str(count("Exchange")),
        "broadcasts": str(count("BroadcastExchange")),
        "joins": ", ".join(sorted(set(joins))) or "-",
        "aggregates": ", ".join(f"{a}×{aggs.count(a)}" for a in sorted(set(aggs))) or "-",
        "other": ", ".join(sorted({x for x in nodes if x in ("TakeOrderedAndProject", "Window", "Expand", "Generate")}))
        or "-",
        "reads": "; ".join(f"{t}({len(c)})" for t, c in sorted(scans.items())) or "-",
    }


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = build_session("local[8]", shuffle_partitions=16)
    print("# Final physical plans\n")
    print(f"Generated by `tools/plan_report.py {sf_dir}` on `local[8]` with AQE; each query was executed once and")
    print("its final adaptive plan summarised. `shuffles` counts hash/range/single-partition exchanges,")
    print("`broadcasts` the broadcast exchanges AQE or a checked hint chose, `reads` the tables scanned")
    print("and the number of columns read from each (column pruning).\n")
    print("| query | shuffles | broadcasts | joins | aggregates | other | reads |")
    print("|---|---|---|---|---|---|---|")
    for name, q in QUERIES.items():
        df = q(spark, sf_dir)
        df.collect()
        s = summarise(formatted(df))
        print(f"| {name} | {s['shuffles']} | {s['broadcasts']} | {s['joins']} | {s['aggregates']} | {s['other']} | "
              f"{s['reads']} |")
    print(NOTES)
    spark.stop()


NOTES = """
## Reading the table at 100 TB

* **Item-grain work is one shuffle of the item fact.** `order_metrics`, the three
  sales marts and the fallbacks shuffle `lineitem`-sized data once, after a
  partial aggregate, and read only the 2-5 columns they use. Everything later in
  those plans runs at order, product or seller grain.
* **Joins run at dimension grain.** Label, category and location queries join
  already-aggregated rows (per product, per customer, per (product, order) pair)
  to a de-duplicated lookup. At sf0.1 AQE broadcasts every such lookup from its
  measured size; when a dimension outgrows the broadcast threshold the same plan
  becomes a sort-merge join, with AQE skew splitting for hot keys.
* **`fact_orders` is the one fact-to-fact join** (orders with per-order metrics).
  Both sides are keyed by `order_id`; the metrics side arrives hash-partitioned
  from its aggregate. At scale it is a sort-merge join (here AQE broadcasts the
  150k-row metrics side); writing the facts bucketed on `order_id` removes both
  exchanges for later order-level joins.
* **Exact distinct counts cost a shuffle each** (`executive_kpis`: orders,
  customers and item sequence numbers are three independent distinct counts,
  hence its 7 exchanges). They are exact because the dashboard figures are exact.
* **Reports that touch many tables pay one small job per table**: `table_counts`
  (ten counts) and `orphan_keys` (six key-grain anti-joins). Their shuffles carry
  per-key counts, not rows.
* **SortAggregate** appears only where the aggregate buffer is a string or a struct
  (deterministic per-key survivor, minimum label). Inputs are dimension-sized except
  for the `dedupe_by_key` operator on the item fact, which is a sort-based partial +
  final aggregate: it spills instead of holding groups in memory, and a hot key is
  reduced in every map task.
* **No plan contains a Cartesian product, a nested-loop join or a Python UDF**
  (asserted in `tests/test_plans.py`), and no window function: the share in
  `payment_behaviour` divides by a scalar subquery.
"""


if __name__ == "__main__":
    main()
