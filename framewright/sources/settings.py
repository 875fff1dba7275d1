"""Credentials of stores, from the environment or a file of settings, for the file systems of a session."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession

#: Usual names of credentials, and the file system settings that they belong to.
SETTINGS = {
    "AWS_ACCESS_KEY_ID": "fs.s3a.access.key",
    "AWS_SECRET_ACCESS_KEY": "fs.s3a.secret.key",
    "AWS_SESSION_TOKEN": "fs.s3a.session.token",
    "AWS_ENDPOINT_URL": "fs.s3a.endpoint",
}


def parse_settings(text: str) -> dict[str, str]:
    """Lines of NAME=value; blank lines and those that begin with # don't count, quotes around a value go."""
    out = {}
    for line in text.splitlines():
        name, equals, value = line.strip().removeprefix("export ").partition("=")
        if equals and not name.startswith("#"):
            value = value.strip()
            out[name.strip()] = value[1:-1] if len(value) > 1 and value[0] == value[-1] and value[0] in "\"'" else value
    return out


def apply_credentials(spark: SparkSession, file: str | None = None, environment: dict[str, str] | None = None) -> list[str]:
    """Set what is known of SETTINGS in the session's Hadoop configuration; returns the settings' names, never values.

    The environment counts before the file. Values go to the configuration only, not into plans, rows or logs.
    """
    known = {}
    if file and os.path.exists(file):
        with open(file, encoding="utf-8") as text:
            known = parse_settings(text.read())
    known |= dict(os.environ if environment is None else environment)
    conf = spark._jsc.hadoopConfiguration()
    found = [name for name in SETTINGS if known.get(name)]
    for name in found:
        conf.set(SETTINGS[name], known[name])
    return [SETTINGS[name] for name in found]
