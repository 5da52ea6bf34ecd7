"""Registered queries of this subpackage and the SQL that some of them equal."""

from __future__ import annotations

from packwatch.llm.bpe import encoded_documents
from packwatch.llm.embedding_dedup import linked_embeddings
from packwatch.llm.lexical_search import RANKED_SQL, ranked_documents
from packwatch.llm.line_dedup import deduplicated_documents
from packwatch.llm.ngram_join import joined_documents
from packwatch.llm.packing import packed_documents
from packwatch.llm.pii import document_spans
from packwatch.llm.quality import JUDGED_SQL, judged_documents
from packwatch.llm.quality_model import scored_documents
from packwatch.llm.sharding import sharded_documents
from packwatch.llm.toxicity import toxic_documents
from packwatch.llm.warc import archived_pages
from packwatch.llm.whitening import whitened_embeddings

QUERIES = {
    "op1_embedding_dedup": linked_embeddings,
    "op2_quality_model": scored_documents,
    "op3_warc": archived_pages,
    "op4_bpe": encoded_documents,
    "op5_sharding": sharded_documents,
    "op6_line_dedup": deduplicated_documents,
    "op7_ngram_join": joined_documents,
    "op8_quality_rules": judged_documents,
    "op9_pii": document_spans,
    "op10_packing": packed_documents,
    "op11_whitening": whitened_embeddings,
    "op12_lexical_search": ranked_documents,
    "op13_toxicity": toxic_documents,
}

ORACLES = {"op8_quality_rules": JUDGED_SQL, "op12_lexical_search": RANKED_SQL}
