"""Every registered query of this subpackage."""

from creditloom.llm import alignment, bpe, chat, decontaminate, gridjoin, licenses, lines, minhash, packing, pii, quality, resampling, toxicity  # noqa: F401
from creditloom.llm.common import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
