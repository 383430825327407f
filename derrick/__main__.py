"""Run the full batch.

    python -m derrick <lake_root> [sf_dir] [--approx] [--tables]
                      [--forest-trees N] [--classifier-trees N] [--iforest-trees N]

Without ``sf_dir`` the nine input tables come from the database or source
folder named by the ``DERRICK_*`` environment variables (see ``LakeConfig``).
"""

import argparse
import sys

from derrick.config import LakeConfig
from derrick.plans.jobs import JobSettings, run_all
from derrick.session import build_session


def main(argv: list[str]) -> None:
    ap = argparse.ArgumentParser(prog="python -m derrick")
    ap.add_argument("lake_root")
    ap.add_argument("sf_dir", nargs="?", default=None,
                    help="driver tables read through the adapters (tests, benchmarks)")
    ap.add_argument("--approx", action="store_true",
                    help="percentile_approx for IQR bounds and medians (bounded memory)")
    ap.add_argument("--tables", action="store_true", help="also replace the mart.* tables")
    ap.add_argument("--forest-trees", type=int, default=200)
    ap.add_argument("--target-forest-trees", type=int, default=300)
    ap.add_argument("--classifier-trees", type=int, default=300)
    ap.add_argument("--iforest-trees", type=int, default=100)
    args = ap.parse_args(argv)
    cfg = LakeConfig.from_env()
    spark = build_session(extra_conf=cfg.spark_conf())
    settings = JobSettings(forest_trees=args.forest_trees,
                           target_forest_trees=args.target_forest_trees,
                           classifier_trees=args.classifier_trees,
                           iforest_trees=args.iforest_trees,
                           approx_quantiles=args.approx)
    run_all(spark, args.lake_root, cfg, sf_dir=args.sf_dir, settings=settings,
            tables=args.tables)
    print("Pipeline completed successfully.")


if __name__ == "__main__":
    main(sys.argv[1:])
