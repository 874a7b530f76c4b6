"""All queries of this subpackage and their oracle SQL."""

from __future__ import annotations

from . import (decontaminate, embedding_dedup, hard_negatives, language_id, license_scan, mixing, ngram_join, packing, pii,
               secret_scan, suffix_dedup, url_filter, whitening)

_MODULES = (suffix_dedup, pii, language_id, decontaminate, secret_scan, ngram_join, packing, embedding_dedup, url_filter, license_scan,
            mixing, hard_negatives, whitening)

QUERIES = {name: f for m in _MODULES for name, f in m.QUERIES.items()}
ORACLE = {name: sql for m in _MODULES for name, sql in m.ORACLE.items()}
