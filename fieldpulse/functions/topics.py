"""Message-topic paths: MQTT filter patterns and the levels of a path."""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F


def topic_matches(topic: Column, pattern: str) -> Column:
    """Whether a topic path matches an MQTT filter.

    ``+`` stands for one level, a final ``#`` for the path itself and everything
    below it.  Filters without ``+`` become equality and prefix tests, which the
    Parquet reader can use to skip row groups; only ``+`` needs a regex.
    """
    levels = pattern.split("/")
    if "#" in levels[:-1]:
        raise ValueError(f"'#' is only allowed as the last level: {pattern}")
    if any(len(level) > 1 and ("#" in level or "+" in level) for level in levels):
        raise ValueError(f"a wildcard must fill its level: {pattern}")
    with_descendants = levels[-1] == "#"
    fixed = levels[:-1] if with_descendants else levels
    if "+" not in fixed:
        path = "/".join(fixed)
        if not with_descendants:
            return topic == path
        if not fixed:
            return topic.isNotNull() & ~topic.startswith("$")
        return (topic == path) | topic.startswith(path + "/")
    body = "/".join("[^/]*" if level == "+" else re.escape(level) for level in fixed)
    guard = "(?!\\$)" if fixed[0] == "+" else ""
    return topic.rlike(f"^{guard}{body}{'(/.*)?' if with_descendants else ''}$")


def topic_level(topic: Column, index: int) -> Column:
    """Level ``index`` (0 = first) of a path, NULL when the path is shorter."""
    return F.get(F.split(topic, "/"), index)
