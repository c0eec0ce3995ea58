"""Write the physical plans of the key operators to PLANS.md (formatted
explain, operator tree only), for review of shuffles, broadcasts and scans."""

import io
import os
import sys
import warnings
from contextlib import redirect_stdout

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
warnings.filterwarnings("ignore")

from orderlens.session import get_spark  # noqa: E402

SF = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"


def tree(df) -> str:
    buf = io.StringIO()
    with redirect_stdout(buf):
        df.explain("formatted")
    text = buf.getvalue()
    return text.split("\n\n(1)")[0].strip()


def main():
    spark = get_spark("local[8]", 16)
    from pyspark.sql import functions as F
    from orderlens import catalog as c
    from orderlens.operators import encode as enc
    from orderlens.operators import metrics as met
    from orderlens.operators.clean import prior_order_count
    from orderlens.operators.contexts import build_contexts
    from orderlens.plans.features import build_features
    from orderlens.sources.leads import city_table, leads_view
    clean = c.clean_set(spark, SF)
    new = c.with_prior(spark, SF).filter(c.is_new_column())
    feats, _ = c.new_cohort_features(spark, SF)
    ff = feats.withColumn("fold", (F.col("row_id") % 5).cast("int"))
    sections = {
        "leads view (scan pruning, broadcast of the 25-row nation table)": leads_view(spark, SF),
        "prior-order window (nested buckets; aggregates before the row window)": prior_order_count(clean),
        "feature build (size-checked lookups, substring theta join on distinct texts)":
            build_features(new, c.load_feature_config(), build_contexts(new, city_table(spark, SF)))[0],
        "out-of-fold target encoding (one group-by per column)":
            enc.oof_target_encode(ff, "city_clean", "buyout_flag", "fold", 10, 0.3, "te"),
        "ranking metrics (distinct scores, bucketed prefix sums)":
            met.cumulative_below(met.score_counts(c.scored(spark, SF)), 0.0, 0.999),
        "threshold grid (rows counted per grid cell)": met.grid_counts(c.scored(spark, SF),
                                                                     met.grid(0.05, 0.81, 0.01)),
    }
    out = ["# Physical plans of the key operators", "",
           f"`python tools/explain_plans.py {SF}` (local[8]; AQE re-plans at runtime, so "
           "sort-merge joins over small inputs become broadcast joins when their shuffle "
           "output is small). Staged tables appear as parquet scans of the shared folder.", ""]
    for title, df in sections.items():
        out += [f"## {title}", "", "```", tree(df), "```", ""]
    with open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md"),
              "w", encoding="utf-8") as f:
        f.write("\n".join(out))
    print("written")


if __name__ == "__main__":
    main()
