"""What the jobs share: settings, a session for the command line, logs."""

from __future__ import annotations

import argparse
import tomllib
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import SparkSession

from lamina.functions.config import logger


def settings(module: str, path: str | None = None) -> dict:
    """A job's settings: those of the TOML file beside it, with those of another file in their place."""
    base = tomllib.loads(Path(module).with_suffix(".toml").read_text(encoding="utf-8"))
    return base | (tomllib.loads(Path(path).read_text(encoding="utf-8")) if path else {})


def log(name: str):
    return logger(f"lamina.jobs.{name}")


def main(module: str, doc: str, run, paths: tuple[str, ...]) -> None:
    """The command line: one argument for each path, and the settings' file. Makes the session and stops it."""
    parser = argparse.ArgumentParser(description=doc.strip().splitlines()[0])
    for p in paths:
        parser.add_argument(f"--{p}", required=True, help="a path that Spark can read or write")
    parser.add_argument("--config", help="a TOML file of settings that replace the defaults")
    args = vars(parser.parse_args())
    config = settings(module, args.pop("config"))
    spark = SparkSession.builder.appName(Path(module).stem).config("spark.sql.session.timeZone", "UTC").getOrCreate()
    try:
        run(spark, **args, config=config)
    finally:
        spark.stop()


@contextmanager
def session_settings(spark: SparkSession, values: dict[str, str]):
    """These settings while a job runs; afterwards the session has its own again."""
    before = {k: spark.conf.get(k, None) for k in values}
    try:
        for k, v in values.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
