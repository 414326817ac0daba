"""Write docs/PLANS.md: physical plans of the headline queries.

usage: python tools/show_plans.py [sf_dir]

For each query: the operator tree of ``explain("formatted")`` plus, per scan,
its pushed filters and read schema, and a count of shuffles / joins.
"""

from __future__ import annotations

import contextlib
import io
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

KEYS = ["delta_upsert", "schema_evolve", "validate_coerce", "sanitize_date", "cursor_max",
        "checkpoint_latest", "run_summary", "status_top20", "dead_letters_latest", "page_progress",
        "paged_delta_scan", "paged_pushdown", "validate_nested", "narrow_nested"]


def formatted(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def summarize(text: str) -> str:
    tree, _, details = text.partition("\n\n\n")
    keep = []
    for block in details.split("\n\n"):
        head = block.strip().splitlines()[0] if block.strip() else ""
        if "Scan" in head:
            keep.append(head)
            for line in block.splitlines():
                if line.startswith(("PushedFilters", "ReadSchema", "PartitionFilters")):
                    keep.append("  " + re.sub(r"file:\S+", "<path>", line))
    return tree.strip() + "\n\n" + "\n".join(keep)


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    from tablesync import registry
    from tablesync.plans.publish import TableStore
    from tablesync.session import get_session, scratch_dir
    from tablesync.sources import fixtures as fx

    spark = get_session("local[8]", shuffle_partitions=16)
    out = ["# Physical plans", "",
           f"Generated by `tools/show_plans.py` on `{sf_dir}` (AQE on; the plans are the",
           "initial adaptive plans, so broadcast choices made at runtime show as",
           "`BroadcastHashJoin` only where the size is known up front).", ""]
    qs = registry.queries()
    for key in KEYS:
        text = summarize(formatted(qs[key](spark, sf_dir)))
        ex = text.count("Exchange")
        out += [f"## {key}", "", f"shuffles: {ex - text.count('BroadcastExchange')}, "
                f"broadcasts: {text.count('BroadcastExchange')}", "", "```", text, "```", ""]
    # The shuffled path: staged keys without a proven size bound (salted join).
    from tablesync.operators.upsert import delta_upsert
    o0 = fx.table(spark, sf_dir, "orders")
    # As with a staged set too big for any broadcast: no static broadcast either.
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    text = summarize(formatted(delta_upsert(fx.orders_base(o0), fx.orders_delta(o0), "o_orderkey")))
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    out += ["## delta upsert, large staged set (salted shuffled anti-join)", "",
            f"shuffles: {text.count('Exchange') - text.count('BroadcastExchange')}, "
            f"broadcasts: {text.count('BroadcastExchange')}", "", "```", text, "```", ""]
    # A published table: the folders of its key buckets, no join left to readers.
    o = fx.table(spark, sf_dir, "orders")
    store = TableStore(spark, scratch_dir(spark, "plans"))
    store.publish("fx2", fx.orders_base(o), run_id="0", pk="o_orderkey")
    store.publish_delta("fx2", fx.orders_delta(o), "o_orderkey", run_id="1")
    text = summarize(formatted(store.current("fx2")))
    out += ["## published table read (key buckets after a delta)", "",
            f"shuffles: {text.count('Exchange') - text.count('BroadcastExchange')}, "
            f"broadcasts: {text.count('BroadcastExchange')}", "", "```", text, "```", ""]
    os.makedirs("docs", exist_ok=True)
    with open("docs/PLANS.md", "w") as fh:
        fh.write("\n".join(out))
    print("wrote docs/PLANS.md")


if __name__ == "__main__":
    main()
