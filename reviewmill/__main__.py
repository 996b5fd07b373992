"""Run the batch job: read both feeds, write the six tables, optionally register them."""

from __future__ import annotations

import argparse
import logging

from reviewmill.plans.batch import run_batch
from reviewmill.sources.session import create_session
from reviewmill.sources.tables import register_tables


def main() -> None:
    parser = argparse.ArgumentParser(prog="reviewmill", description=__doc__)
    parser.add_argument("reviews", help="folder of the review feed")
    parser.add_argument("products", help="folder of the product feed")
    parser.add_argument("base", help="folder below which the six tables are written")
    parser.add_argument("--database", help="register the tables in this database, too")
    parser.add_argument("--partitions", type=int, help="partitions that shuffles start with")
    parser.add_argument("--spread", action="store_true", help="even out feeds in unsplittable files")
    parser.add_argument("--salts", type=int, help="first-level groups of a hot review id")
    parser.add_argument("--limit", action="append", default=[], metavar="CHECK=MOST", help="audit a check against a limit")
    parser.add_argument("--keep", type=int, default=2, help="publications that stay")
    parser.add_argument("--no-quarantine", action="store_true", help="don't keep faulty lines")
    options = parser.parse_args()
    logging.basicConfig(level=logging.INFO)
    spark = create_session()
    try:
        run_batch(
            spark,
            options.reviews,
            options.products,
            options.base,
            options.partitions,
            options.spread,
            options.salts,
            {name: float(most) for name, _, most in (x.partition("=") for x in options.limit)},
            options.keep,
            not options.no_quarantine,
        )
        if options.database:
            register_tables(spark, options.base, options.database)
    except Exception:
        logging.exception("the batch job failed")
        raise
    finally:
        spark.stop()


if __name__ == "__main__":
    main()
