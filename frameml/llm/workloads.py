"""The registered queries of this subpackage."""

from frameml.llm import (conversation_trie, decontamination, embedding_neardup, html_text, jaccard_join, language, licenses, packing, pii,
                         quality, sentence_pieces, spelling, suffix_dedup)

_MODULES = (embedding_neardup, decontamination, quality, packing, licenses, language, html_text, jaccard_join, pii, suffix_dedup,
            sentence_pieces, spelling, conversation_trie)

QUERIES = {name: query for module in _MODULES for name, query in module.QUERIES.items()}
SQL = {name: sql for module in _MODULES for name, sql in module.SQL.items()}
