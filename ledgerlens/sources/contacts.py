"""Contact sheet for the confirmation job."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.constants import CONTACT_ALIASES
from ledgerlens.functions.confirm import strip_text


def read_contacts_csv(spark: SparkSession, path: str) -> DataFrame:
    """Read a contact CSV with every column as text (no type inference)."""
    return spark.read.csv(path, header=True, inferSchema=False)


def column_for(names: Sequence[str], columns: Sequence[str]) -> str | None:
    """The sheet column whose header is the earliest of ``names`` (ignoring case and outer blanks),
    the leftmost if several share it; None if no header is listed."""
    rank = {name: place for place, name in enumerate(names)}
    listed = [(rank[c.strip().lower()], place) for place, c in enumerate(columns) if c.strip().lower() in rank]
    return columns[min(listed)[1]] if listed else None


def resolve_aliases(columns: Sequence[str],
                    aliases: Mapping[str, Sequence[str]] = CONTACT_ALIASES) -> dict[str, str | None]:
    """The sheet column of each canonical name."""
    return {canonical: column_for(names, columns) for canonical, names in aliases.items()}


def confirm_contacts(raw: DataFrame, aliases: Mapping[str, Sequence[str]] = CONTACT_ALIASES) -> DataFrame:
    """The sheet with ``nome_cliente``, ``telefone`` and ``notas_fiscais`` as text in front.

    Name and phone are required (``ValueError``); without a notes column the notes
    are empty. Rows whose phone is NULL, blank or the text ``nan`` are dropped.
    Other columns follow unchanged, unless they carry one of the three names.
    """
    source = resolve_aliases(raw.columns, aliases)
    lacking = [name for name in ("nome_cliente", "telefone") if not source[name]]
    if lacking:
        raise ValueError(f"the contact sheet has no column for {lacking}; its columns: {raw.columns}")
    front = [F.col(f"`{column}`").cast("string").alias(name) if column else F.lit("").alias(name)
             for name, column in source.items()]
    taken = {*source, *source.values()}
    sheet = raw.select(*front, *[F.col(f"`{c}`") for c in raw.columns if c not in taken])
    return sheet.filter(~F.coalesce(strip_text("telefone"), F.lit("")).isin("", "nan"))
