"""Imports every operator so that its query registers; QUERIES and ORACLE are the result."""

from docflow.llm import (  # noqa: F401
    bpe_codec,
    decontam,
    exact,
    fingerprints,
    minhash,
    phrases,
    secret_scan,
    sharding,
    substring,
    token_count,
    toxicity,
    warc,
    whitening,
)
from docflow.llm.common import ORACLE, QUERIES  # noqa: F401
