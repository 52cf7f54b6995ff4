"""Pieces of DuckDB SQL that several queries need."""

from __future__ import annotations

_BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
_POLYNOMIAL = 0xEDB88320


def crc32(text: str) -> str:
    """The unsigned CRC-32 of a string expression's UTF-8 bytes, half a byte at a time."""
    table = []
    for value in range(16):
        for _ in range(4):
            value = (value >> 1) ^ (_POLYNOMIAL if value & 1 else 0)
        table.append(value)
    entries = ", ".join(f"{x}::BIGINT" for x in table)
    digits = f"hex(encode({text}))"
    halves = (
        f"list_transform(range(1, length({digits}) + 1), "
        f"lambda i: (strpos('0123456789ABCDEF', {digits}[CASE WHEN i % 2 = 1 THEN i + 1 ELSE i - 1 END]) - 1)::BIGINT)"
    )
    step = f"lambda c, x: xor(c >> 4, [{entries}][(xor(c, x) & 15) + 1])"
    return f"xor(list_reduce({halves}, {step}, 4294967295::BIGINT), 4294967295::BIGINT)"


def base32(digits: str) -> str:
    """Base32 of an expression of hexadecimal digits, a multiple of five of them."""
    return (
        f"list_aggregate(list_transform(range(0, length({digits}) // 5 * 4), lambda i: substr('{_BASE32}', "
        f"((('0x' || substr({digits}, (i // 4 * 5 + 1)::INT, 5))::BIGINT >> (15 - i % 4 * 5)::INT) & 31)::INT + 1, 1)), "
        f"'string_agg', '')"
    )
