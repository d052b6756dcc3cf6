"""CRC-32 in SQL, for engines that have no such function."""

from __future__ import annotations


def crc32_sql(text: str) -> str:
    """Unsigned CRC-32 of the UTF-8 bytes of the expression ``text``: every byte is added, then moved by eight bits."""
    digits = f"hex(encode({text}))"
    octets = f"list_transform(range(1, length({digits}), 2), lambda k : CAST('0x' || substr({digits}, k, 2) AS BIGINT))"
    steps = f"flatten(list_transform({octets}, lambda b : [b, -1, -1, -1, -1, -1, -1, -1, -1]))"
    folded = (
        f"list_reduce(list_concat([4294967295], {steps}), lambda c, b : "
        "CASE WHEN b >= 0 THEN xor(c, b) WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END)"
    )
    return f"xor({folded}, 4294967295)"
