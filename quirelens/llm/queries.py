"""Imports every operator module, so that its queries are registered."""

from quirelens.llm import decontamination, huffman, jaccard, langid, maglev, packing, periodic, pii, quality, spelling, suffixes, toxicity, url_rules  # noqa: F401
from quirelens.llm.common import CHECKS, QUERIES  # noqa: F401
