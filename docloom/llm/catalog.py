"""All queries of this subpackage; importing a module registers its queries."""

from docloom.llm import (  # noqa: F401
    decontamination, lexical_search, licenses, line_dedup, lm_score, mixture, prefix_trie, quality, sharding, simhash, suffix_dedup, token_files,
    url_rules)
from docloom.llm.registry import ORACLES, QUERIES  # noqa: F401
