"""Parts of SQL that several queries' texts share."""

from __future__ import annotations

#: A one-row table with the 256 values of the reflected CRC-32 (polynomial 0xEDB88320).
CRC_TABLE = """crc_table AS (
  SELECT list_transform(range(256), lambda n: list_reduce([n, 0, 0, 0, 0, 0, 0, 0, 0],
    lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::BIGINT) ELSE c >> 1 END)) AS crc
)"""


def crc32_of(blob: str) -> str:
    """The unsigned CRC-32 of a blob; crc_table must be among the tables selected from."""
    hexes = f"hex({blob})"
    found = f"list_transform(range(octet_length({blob})), lambda i: CAST('0x' || {hexes}[2 * i + 1 : 2 * i + 2] AS BIGINT))"
    folded = f"list_reduce(list_concat([4294967295::BIGINT], {found}), lambda c, b: xor(c >> 8, crc[xor(c & 255, b) + 1]))"
    return f"xor({folded}, 4294967295::BIGINT)"
