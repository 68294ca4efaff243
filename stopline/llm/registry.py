"""The queries of this subpackage; importing it registers them."""

from __future__ import annotations

import corpus_pipeline
from stopline.llm.queries import ORACLES as _ORACLES
from stopline.llm.queries import QUERIES as _QUERIES

QUERIES = _QUERIES | {"pipeline": corpus_pipeline.run}
ORACLES = _ORACLES | ({"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {})
