"""Command line: millrace CONFIG OUTPUT."""

from __future__ import annotations

import argparse
import logging
import logging.config
import sys

from .config import ConfigError, expanded, read_config, read_logging

NOT_WRITABLE, WRITE_FAILED = 22, 23


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="millrace", description="Builds a text corpus from the sources that a YAML file names.")
    parser.add_argument("config")
    parser.add_argument("output")
    parser.add_argument("--strict", action="store_true", help="correct markup quirks")
    parser.add_argument("--quarantine", help="where what can't be read goes, as JSON lines (OUTPUT.quarantine)")
    parser.add_argument("--ordered", action="store_true", help="lines by language, source and entity")
    try:
        args = parser.parse_args(argv)
    except SystemExit as e:
        return 1 if e.code else 0
    try:
        config, messages = read_config(args.config), read_logging(args.config)
        if messages is None:
            logging.basicConfig(level=logging.INFO, format="%(asctime)s %(levelname)s %(message)s")
        else:
            try:
                logging.config.dictConfig(messages)
            except (ValueError, TypeError, AttributeError, ImportError) as e:
                raise ConfigError(f"{args.config}: logging: {e}", 2) from e
    except ConfigError as e:
        print(e, file=sys.stderr)
        return e.exit_code
    from pyspark.errors import PySparkException
    from pyspark.sql import SparkSession

    from .pipeline import AuditError, build, is_writable

    spark = SparkSession.builder.appName("millrace").getOrCreate()
    output = expanded(args.output)
    if not is_writable(spark, output):
        print(f"can't write {output}", file=sys.stderr)
        return NOT_WRITABLE
    try:
        for row in build(spark, config, output, args.strict, args.ordered, args.quarantine and expanded(args.quarantine)).orderBy("lang", "source").collect():
            logging.info("%s %s: %d entities, %d erroneous", row.lang, row.source, row.entities_read, row.erroneous)
    except ConfigError as e:
        print(e, file=sys.stderr)
        return e.exit_code
    except AuditError as e:
        print(e, file=sys.stderr)
        return WRITE_FAILED
    except PySparkException as e:
        print(str(e).splitlines()[0], file=sys.stderr)
        return WRITE_FAILED
    return 0


if __name__ == "__main__":
    sys.exit(main())
