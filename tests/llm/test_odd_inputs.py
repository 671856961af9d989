"""Empty tables, and other columns with names that the operators use inside."""

import public_tokenizers
import pytest

from folioflow.llm import decontamination, language_id, lm_scoring, mixing, near_dedup, pii, quality_rules, sharding, simhash, token_ids

PATH = public_tokenizers.path("word_bpe_49k.json")
DIGESTS = {
    "quality": lambda d, b, la: quality_rules.quality_verdicts(d, la),
    "decontamination": lambda d, b, la: decontamination.contamination(d, b),
    "pii": lambda d, b, la: pii.find(d),
    "mixing": lambda d, b, la: mixing.mix(d),
    "lm": lambda d, b, la: lm_scoring.score(d),
    "simhash": lambda d, b, la: simhash.near_components(d),
    "language": lambda d, b, la: language_id.identify(d),
    "sharding": lambda d, b, la: sharding.assign(d),
    "tokens": lambda d, b, la: token_ids.encode_corpus(d, PATH),
}
FILTERS = {
    "quality": lambda d, b, la: quality_rules.quality_filter(d, la),
    "dedup": lambda d, b, la: near_dedup.near_dedup(d),
    "decontamination": lambda d, b, la: decontamination.decontaminate(d, b),
    "mixing": lambda d, b, la: mixing.mixed_corpus(d),
    "redaction": lambda d, b, la: pii.redact(d),
}


@pytest.mark.parametrize("name", DIGESTS)
def test_empty_and_wide(empty, wide, odd, benchmark, labels, name):
    f = DIGESTS[name]
    assert f(empty, benchmark.limit(0), labels.limit(0)).count() == 0
    assert f(wide, benchmark.limit(0), labels.limit(0)).count() == odd.count()


@pytest.mark.parametrize("name", FILTERS)
def test_filters_keep_columns(empty, wide, benchmark, labels, name):
    f = FILTERS[name]
    assert f(empty, benchmark, labels).count() == 0
    out = f(wide, benchmark, labels)
    assert out.columns == wide.columns and 0 < out.count() <= 3 * wide.count()


def test_sharded_keeps_columns(wide):
    out = sharding.sharded(wide)
    assert out.columns[: len(wide.columns)] == wide.columns and len(out.columns) == len(wide.columns) + 2 and out.count() == wide.count()
