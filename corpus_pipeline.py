"""The training-data pipeline: documents to packed token sequences (see
``mercato.llm.pipeline``)."""

from mercato.llm.pipeline import (MIN_SCORE, ORACLE_SQL, STAGES, decontaminate, language, near_duplicates, pack,  # noqa: F401
                                  personal_data, run)
