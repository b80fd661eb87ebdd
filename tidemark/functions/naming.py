"""Table names derived from topic names."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Everything between the first and the last dot goes, dashes become underscores.
MIDDLE_PARTS = r"[.].*[.]"
DASH = "-"


def base_name(topic: str) -> str:
    return re.sub(MIDDLE_PARTS, ".", topic).replace(DASH, "_")


def scd2_name(topic: str) -> str:
    return f"{base_name(topic)}_scd2"


def history_name(topic: str) -> str:
    return f"{base_name(topic)}_hist"


def changes_name(topic: str) -> str:
    return f"{base_name(topic)}_changes"


def quarantine_name(topic: str) -> str:
    return f"{base_name(topic)}_bad"


def flat_name(topic: str) -> str:
    return f"fso.{base_name(topic)}"


def base_name_column(topic: Column) -> Column:
    """The same rule for a column of topic names."""
    return F.regexp_replace(F.regexp_replace(topic, MIDDLE_PARTS, "."), DASH, "_")


def quoted(name: str) -> str:
    """Backtick-quote every part of a dotted identifier."""
    return ".".join("`" + part.replace("`", "``") + "`" for part in name.split("."))
