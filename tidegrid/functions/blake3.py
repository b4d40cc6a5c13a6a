"""BLAKE3 of many short messages at once, as numpy over whole Arrow batches.

A message of at most 64 bytes is one block, and the digest is the first half of a single
compression with the flags chunk-start, chunk-end and root. All messages of a call have the same
length, so word positions past the end are zero in every row and are never added.
"""

from __future__ import annotations

import numpy as np

# Fixed values of the published algorithm.
INITIAL = (
    0x6A09E667, 0xBB67AE85, 0x3C6EF372, 0xA54FF53A, 0x510E527F, 0x9B05688C, 0x1F83D9AB, 0x5BE0CD19,
)
PERMUTATION = (2, 6, 3, 10, 7, 0, 4, 13, 1, 11, 12, 5, 9, 14, 15, 8)
CHUNK_START, CHUNK_END, ROOT = 1, 2, 8
ROUNDS = 7

ROWS_AT_ONCE = 16384  # the sixteen state words of this many rows stay in the cache


def _schedule() -> list[tuple[int, ...]]:
    order = tuple(range(16))
    rounds = [order]
    for _ in range(ROUNDS - 1):
        order = tuple(order[i] for i in PERMUTATION)
        rounds.append(order)
    return rounds


SCHEDULE = _schedule()
COLUMNS = ((0, 4, 8, 12), (1, 5, 9, 13), (2, 6, 10, 14), (3, 7, 11, 15))
DIAGONALS = ((0, 5, 10, 15), (1, 6, 11, 12), (2, 7, 8, 13), (3, 4, 9, 14))


def _rotate_right(word: np.ndarray, bits: int, spare: np.ndarray) -> None:
    np.right_shift(word, np.uint32(bits), out=spare)
    np.left_shift(word, np.uint32(32 - bits), out=word)
    np.bitwise_or(word, spare, out=word)


def _mix(a, b, c, d, x, y, spare) -> None:
    for message, far, near in ((x, 16, 12), (y, 8, 7)):
        np.add(a, b, out=a)
        if message is not None:
            np.add(a, message, out=a)
        np.bitwise_xor(d, a, out=d)
        _rotate_right(d, far, spare)
        np.add(c, d, out=c)
        np.bitwise_xor(b, c, out=b)
        _rotate_right(b, near, spare)


def _compress(words: np.ndarray, length: int, out: np.ndarray) -> None:
    used, rows = words.shape
    constants = (*INITIAL, *INITIAL[:4], 0, 0, length, CHUNK_START | CHUNK_END | ROOT)
    state = np.empty((16, rows), dtype=np.uint32)
    state[:] = np.array(constants, dtype=np.uint32)[:, None]
    spare = np.empty(rows, dtype=np.uint32)
    message = [words[i] if i < used else None for i in range(16)]
    for order in SCHEDULE:
        for step, lanes in enumerate((*COLUMNS, *DIAGONALS)):
            a, b, c, d = (state[i] for i in lanes)
            _mix(a, b, c, d, message[order[2 * step]], message[order[2 * step + 1]], spare)
    np.bitwise_xor(state[:8], state[8:], out=out)


def digest_words(words: np.ndarray, length: int) -> np.ndarray:
    """Digests of messages given as little-endian words, shape (words, rows) to (rows, 8)."""
    if words.shape[0] > 16 or length > 64:
        raise ValueError("only messages of one block")
    rows = words.shape[1]
    digests = np.empty((8, rows), dtype=np.uint32)
    for start in range(0, rows, ROWS_AT_ONCE):
        part = slice(start, min(start + ROWS_AT_ONCE, rows))
        _compress(np.ascontiguousarray(words[:, part]), length, digests[:, part])
    return np.ascontiguousarray(digests.T)


HEX_PAIRS = np.frombuffer("".join(f"{i:02x}" for i in range(256)).encode(), dtype="<u2")


def hex_bytes(digests: np.ndarray) -> np.ndarray:
    """Lower-case hex of digests, as one flat byte buffer with 64 bytes per row."""
    return HEX_PAIRS[digests.astype("<u4", copy=False).view(np.uint8)].view(np.uint8).reshape(-1)


def digest_messages(messages: list[bytes]) -> list[str]:
    """Hex digests of messages of equal length up to 64 bytes."""
    length = len(messages[0])
    if any(len(m) != length for m in messages):
        raise ValueError("messages must have one length")
    padded = b"".join(m.ljust(64, b"\0") for m in messages)
    words = np.frombuffer(padded, dtype="<u4").reshape(len(messages), 16).T
    text = hex_bytes(digest_words(words, length)).tobytes().decode()
    return [text[i : i + 64] for i in range(0, len(text), 64)]
