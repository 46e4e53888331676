"""Find suspect words in large, noisy text archives with Spark."""

from smudgelex.functions.render import document_json, document_string, token_string
from smudgelex.operators.align import align_readings, difference_counts
from smudgelex.operators.compare import (
    different_places,
    reconcile,
    reconcile_readings,
    same_token,
    same_token_and_position,
)
from smudgelex.operators.lexicon import (
    build_lexicon,
    documents_per_source,
    lexicon_of,
    words_of,
)
from smudgelex.operators.tag import (
    heavy_words,
    kind_counts,
    known_tokens,
    missing_tokens,
    of_kind,
    read_reference_keys,
    reference_keys,
    tag_lexicon,
    tag_tokens,
    tokens_processed,
)
from smudgelex.operators.tokenize import (
    doc_lengths,
    doc_stats,
    entity_counts,
    last_tokens,
    of_type,
    phrases,
    tag_events,
    tokenize,
    with_last_flag,
)
from smudgelex.plans.jobs import corpus_report, print_tokens, tag_words
from smudgelex.plans.metrics import StreamMetrics, observe_documents, observe_tokens
from smudgelex.sources.corpus import (
    extract_documents,
    first_documents,
    first_per_group,
    read_corpus,
    read_documents,
    stream_corpus,
    stream_documents,
)
from smudgelex.sources.key_tables import store_keys, stored_keys
from smudgelex.sources.sinks import (
    write_missing,
    write_token_table,
    write_tokens,
    write_trec,
)
from smudgelex.sources.tables import read_lexicon, read_reference
from smudgelex.streaming.jobs import (
    compact_counts,
    read_counts,
    write_counts,
    write_token_stream,
)
from smudgelex.streaming.lexicon_store import LexiconStore, write_lexicon

__all__ = [
    "LexiconStore",
    "StreamMetrics",
    "align_readings",
    "build_lexicon",
    "compact_counts",
    "corpus_report",
    "difference_counts",
    "different_places",
    "doc_lengths",
    "doc_stats",
    "document_json",
    "document_string",
    "documents_per_source",
    "entity_counts",
    "extract_documents",
    "first_documents",
    "first_per_group",
    "heavy_words",
    "kind_counts",
    "known_tokens",
    "last_tokens",
    "lexicon_of",
    "missing_tokens",
    "observe_documents",
    "observe_tokens",
    "of_kind",
    "of_type",
    "phrases",
    "print_tokens",
    "read_corpus",
    "read_counts",
    "read_documents",
    "read_lexicon",
    "read_reference",
    "read_reference_keys",
    "reconcile",
    "reconcile_readings",
    "reference_keys",
    "same_token",
    "same_token_and_position",
    "store_keys",
    "stored_keys",
    "stream_corpus",
    "stream_documents",
    "tag_events",
    "tag_lexicon",
    "tag_tokens",
    "tag_words",
    "token_string",
    "tokenize",
    "tokens_processed",
    "with_last_flag",
    "words_of",
    "write_counts",
    "write_lexicon",
    "write_missing",
    "write_token_stream",
    "write_token_table",
    "write_tokens",
    "write_trec",
]
