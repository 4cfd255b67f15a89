"""All queries of this subpackage; importing an operator registers its query."""

from medallion.llm import alignment, hamming_dedup, html_extraction, language_model, line_quality, mixing, packing, quotation, secrets, token_files, toxicity, whitening, winnowing  # noqa: F401
from medallion.llm.registry import QUERIES, SQL  # noqa: F401
