"""All queries of this subpackage; importing the modules registers them."""

from flowatlas.llm import (  # noqa: F401
    centroids, chat, codes, decontaminate, neardup, packing, quality, repeats, secrets, toxicity, urls, warc, wavelet)
from flowatlas.llm.common import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
