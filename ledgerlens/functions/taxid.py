"""Tax-id (CPF/CNPJ) column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerlens.constants import (
    CNPJ_LENGTH,
    CPF_LENGTH,
    TAX_ID_PUNCTUATION,
    TAX_ID_TYPE_CNPJ,
    TAX_ID_TYPE_CPF,
    TAX_ID_TYPE_INVALID,
)
from ledgerlens.functions._util import as_col


def tax_id_clean(c) -> Column:
    """Remove dots, dashes, slashes and spaces; every other character stays."""
    return F.translate(as_col(c), TAX_ID_PUNCTUATION, "")


def tax_id_length(c) -> Column:
    """Character count of the cleaned id (no blanks remain, so no trailing-blank rule applies)."""
    return F.length(tax_id_clean(c))


def tax_id_type(length) -> Column:
    """11 characters: person (CPF); 14: company (CNPJ); else invalid. Takes the length column."""
    n = as_col(length)
    return (
        F.when(n == CPF_LENGTH, F.lit(TAX_ID_TYPE_CPF))
        .when(n == CNPJ_LENGTH, F.lit(TAX_ID_TYPE_CNPJ))
        .otherwise(F.lit(TAX_ID_TYPE_INVALID))
    )
