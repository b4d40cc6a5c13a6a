"""BLAKE3 of six 32-bit floats as plain SQL, to check the fingerprints against.

A message of up to 64 bytes is one block: seven rounds, each of two layers of four independent mixings of the 16 words of
state. A layer is eight steps, and each step one SELECT over the one before.
"""

from __future__ import annotations

# Fixed values of the published algorithm: initial words, the order in which each round takes the message, and flags.
INITIAL = (0x6A09E667, 0xBB67AE85, 0x3C6EF372, 0xA54FF53A, 0x510E527F, 0x9B05688C, 0x1F83D9AB, 0x5BE0CD19)
ORDER = (2, 6, 3, 10, 7, 0, 4, 13, 1, 11, 12, 5, 9, 14, 15, 8)
COLUMNS = ((0, 4, 8, 12), (1, 5, 9, 13), (2, 6, 10, 14), (3, 7, 11, 15))
DIAGONALS = ((0, 5, 10, 15), (1, 6, 11, 12), (2, 7, 8, 13), (3, 4, 9, 14))
ONE_BLOCK = 1 | 2 | 8  # first, last, root
BYTES = 24


def _turned(value: str, bits: int) -> str:
    return f"((({value}) >> {bits}) | (({value}) << {32 - bits})) & 4294967295"


def float_bits(value: str) -> str:
    return f"CAST(CAST(CAST(CAST({value} AS FLOAT) AS BIT) AS UINTEGER) AS UBIGINT)"


def blake3_ctes(source: str, values: tuple[str, ...], keep: str, name: str = "hashed") -> str:
    """CTEs ending in ``name``: the columns ``keep`` of ``source`` and ``digest``, 64 hex digits over six floats."""
    words = [f"m{i}" if i < len(values) else "0::UBIGINT" for i in range(16)]
    messages = [f"m{i}" for i in range(len(values))]
    start = [*INITIAL, *INITIAL[:4], 0, 0, BYTES, ONE_BLOCK]
    steps = [
        f"b0 AS (SELECT {keep}, {', '.join(f'{float_bits(v)} AS {m}' for v, m in zip(values, messages))}, "
        f"{', '.join(f'{v}::UBIGINT AS s{i}' for i, v in enumerate(start))} FROM {source})"
    ]

    def step(changed: dict[int, str]) -> None:
        state = ", ".join(f"{changed[i]} AS s{i}" if i in changed else f"s{i}" for i in range(16))
        steps.append(f"b{len(steps)} AS (SELECT {keep}, {', '.join(messages)}, {state} FROM b{len(steps) - 1})")

    for _ in range(7):
        for layer, groups in enumerate((COLUMNS, DIAGONALS)):
            for half, (right, left) in enumerate(((16, 12), (8, 7))):
                mixed = [words[8 * layer + 2 * i + half] for i in range(4)]
                step({a: f"(s{a} + s{b} + {m}) & 4294967295" for (a, b, _, _), m in zip(groups, mixed)})
                step({d: _turned(f"xor(s{d}, s{a})", right) for a, _, _, d in groups})
                step({c: f"(s{c} + s{d}) & 4294967295" for _, _, c, d in groups})
                step({b: _turned(f"xor(s{b}, s{c})", left) for _, b, c, _ in groups})
        words = [words[i] for i in ORDER]
    # The bytes of a word come lowest first.
    parts = []
    for i in range(8):
        word = f"xor(s{i}, s{i + 8})"
        parts.append(f"format('{{:08x}}', (({word} & 255) << 24) | (({word} & 65280) << 8) | (({word} >> 8) & 65280) | ({word} >> 24))")
    steps.append(f"{name} AS (SELECT {keep}, {' || '.join(parts)} AS digest FROM b{len(steps) - 1})")
    return ",\n".join(steps)
