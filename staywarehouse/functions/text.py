"""Null tokens, GUID repair, short ids and attribute hashes.

The functions take column names (or SQL text) and return SQL text.
"""

from __future__ import annotations

from collections.abc import Sequence

# Texts that stand for a missing value (any case, not trimmed).
NULL_TOKENS = ("none", "nan", "null")

SEED = 42

#: Texts that differ by case or trailing blanks only are equal in it.
FOLDED = "UTF8_LCASE_RTRIM"


def null_token(column: str) -> str:
    tokens = ", ".join(f"'{t}'" for t in NULL_TOKENS)
    return f"CASE WHEN lower({column}) NOT IN ({tokens}) THEN {column} END"


def is_guid(column: str) -> str:
    """36 characters of which exactly 32 are hexadecimal digits and four are hyphens."""
    digits = f"replace({column}, '-', '')"
    return f"coalesce(length({column}) = 36 AND {digits} RLIKE '^[0-9a-fA-F]{{32}}$', false)"


def guid_from(text: str) -> str:
    """Shape the MD5 of a text as 8-4-4-4-12."""
    return (f"regexp_replace(md5({text}), '^(.{{8}})(.{{4}})(.{{4}})(.{{4}})(.{{12}})$', "
            "'$1-$2-$3-$4-$5')")


def repair_guid(column: str, key: str) -> str:
    """Keep a valid GUID; otherwise derive one from column name, business key and value.

    The business key takes part so that two rows with the same raw value get different
    ids, and a reload of the same row gets the same id.
    """
    source = f"concat_ws(':', '{column}', cast({key} as string), coalesce({column}, ''))"
    return f"CASE WHEN {is_guid(column)} THEN {column} ELSE {guid_from(source)} END"


def short_id(prefix: str, index: str, seed: int = SEED) -> str:
    """``prefix_`` and the first eight hex digits of MD5(``prefix_index_seed``)."""
    source = f"concat_ws('_', '{prefix}', cast({index} as string), '{seed}')"
    return f"concat('{prefix}_', substring(md5({source}), 1, 8))"


def attribute_hash(columns: Sequence[str], sep: str = "") -> str:
    """Lowercase hex SHA-256 over the texts of the columns, NULL as the empty text."""
    texts = ", ".join(f"coalesce(cast({c} as string), '')" for c in columns)
    return f"sha2(concat_ws('{sep}', {texts}), 256)"
