"""Lower-cased words of whole texts as bytes: runs of ASCII letters and digits and of anything beyond ASCII."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa

#: A-Z become a-z; ASCII that is neither a letter nor a digit becomes a blank.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
#: Bytes of a text that are split at a time, so that a very long text never stands as words all at once.
RUN = 1 << 20


def word_runs(raw: bytes | None, size: int = RUN) -> Iterator[list[bytes]]:
    """The words of a text in order, in lists that stand for about `size` bytes each; none for null."""
    if not raw:
        return
    folded = raw.translate(_FOLD)
    at = 0
    while at < len(folded):
        end = folded.find(b" ", at + size)
        end = len(folded) if end < 0 else end
        yield folded[at:end].split()
        at = end + 1


def raw_texts(column: pa.Array) -> list[bytes | None]:
    """UTF-8 bytes of a column of strings."""
    return column.cast(pa.binary()).to_pylist()
