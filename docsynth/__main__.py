"""Command line: build a dataset from a template folder.

    spark-submit -m docsynth --base_path forms/ --out out/ --num_files 100 \
        --first_names first.parquet --last_names last.parquet \
        --indian_names indian.parquet --font_metrics helvetica.parquet

``--augment`` takes true/false (not Python truthiness of any text).
"""

from __future__ import annotations

import argparse

from .plans.dataset import Dictionaries, build_dataset
from .session import get_spark


def _bool(v: str) -> bool:
    if v.lower() in ("true", "1", "yes"):
        return True
    if v.lower() in ("false", "0", "no"):
        return False
    raise argparse.ArgumentTypeError(f"not a boolean: {v}")


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(description="Generate a synthetic filled-form dataset.")
    ap.add_argument("--base_path", required=True)
    ap.add_argument("--out", required=True)
    ap.add_argument("--num_files", type=int, required=True)
    ap.add_argument("--augment", type=_bool, default=True)
    ap.add_argument("--seed", type=int, default=0)
    for name in ("first_names", "last_names", "indian_names", "font_metrics"):
        ap.add_argument(f"--{name}", required=True, help="parquet path")
    a = ap.parse_args(argv)
    spark = get_spark(master=None)
    d = Dictionaries(*(spark.read.parquet(getattr(a, n))
                       for n in ("first_names", "last_names", "indian_names", "font_metrics")))
    for k, v in build_dataset(spark, a.base_path, a.out, a.num_files, d, a.seed, a.augment).items():
        print(k, v)


if __name__ == "__main__":
    main()
