"""A public piece vocabulary (SentencePiece model file) as plain arrays.

The file's path is a parameter; the driver reads it once and sends the bytes
(half a megabyte) to the tasks. Only the tokenizer's data come from the file;
segmentation is done here.
"""

from __future__ import annotations

import os
import re
from dataclasses import dataclass, field
from functools import lru_cache

SPACE = "▁"
#: Where the public vocabulary files lie on this machine.
TOKENIZERS = os.environ.get("PUBLIC_TOKENIZERS", "/opt/tokenizers")
PIECES_32K = os.path.join(TOKENIZERS, "piece_bpe_32k.model")

#: Text is cut into chunks that no piece crosses: the spaces before a word and
#: the word, a line feed, or spaces that no word follows.
CHUNK = re.compile(r" *[^ \n]+|\n| +")


@dataclass
class Pieces:
    """``ids``: piece text (with plain spaces) to id; ``scores`` and ``text``
    by id; ``byte_ids``: byte value to id."""

    text: list[str] = field(default_factory=list)
    scores: list[float] = field(default_factory=list)
    ids: dict[str, int] = field(default_factory=dict)
    byte_ids: list[int] = field(default_factory=list)
    raw: list[bytes] = field(default_factory=list)


def read_model(spark, path: str = PIECES_32K) -> bytes:
    """The model file's bytes, from a local path or any store Spark reads."""
    if os.path.exists(path):
        with open(path, "rb") as f:
            return f.read()
    return bytes(spark.read.format("binaryFile").load(path).select("content").first().content)


@lru_cache(maxsize=2)
def load(model: bytes) -> Pieces:
    """Parse and check a model: byte fallback, no unused pieces, and no piece
    that crosses a chunk boundary, so that chunks segment independently."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_proto=model)
    out = Pieces(byte_ids=[-1] * 256)
    for i in range(sp.get_piece_size()):
        p = sp.id_to_piece(i)
        out.scores.append(sp.get_score(i))
        if sp.is_byte(i):
            out.byte_ids[int(p[3:5], 16)] = i
            out.text.append("")
            out.raw.append(bytes([int(p[3:5], 16)]))
        elif sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i):
            if sp.is_unused(i):
                raise ValueError("models with unused pieces are not supported")
            out.text.append("")
            out.raw.append(b"")
        else:
            if re.search(f"[^{SPACE}]{SPACE}|\n.|.\n| ", p, re.S):
                raise ValueError(f"piece {p!r} crosses a chunk boundary")
            plain = p.replace(SPACE, " ")
            out.text.append(plain)
            out.raw.append(plain.encode())
            out.ids[plain] = i
    if -1 in out.byte_ids:
        raise ValueError("the model has no byte fallback")
    lost = {c for p in out.ids for c in p if c not in out.ids}
    if lost:
        raise ValueError(f"characters without a piece of their own: {sorted(lost)[:5]}")
    return out
