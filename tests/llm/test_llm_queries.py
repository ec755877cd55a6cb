"""Queries of the training-data problems against their SQL or a brute-force version, on the smallest tables."""

import pytest

from helpers import same
from tallyloom.llm.queries import QUERIES, SQL
from tallyloom.plans.tables import read

SF = "/root/testdata/sf0.001"
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.json"


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_against_sql(spark, oracle, name):
    same(QUERIES[name](spark, SF), oracle.sql(SQL[name]))


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(VOCABULARY)
    t.encode_special_tokens = True
    return lambda x: t.encode(x or "", add_special_tokens=False).ids


def test_ids_of_the_documents(spark, library):
    want = sorted((r.doc_id, library(r.text)) for r in read(spark, SF, "documents").collect())
    assert sorted((r.doc_id, [*r.ids]) for r in QUERIES["p6_ids"](spark, SF).collect()) == want


def test_short_sources(spark, library):
    from tallyloom.functions.text import WHITE_SPACE

    tokens = {}
    for r in read(spark, SF, "documents").collect():
        if r.source is not None:
            s = r.source.strip(WHITE_SPACE).lower()
            tokens[s] = tokens.get(s, 0) + len(library(r.text))
    targets = read(spark, SF, "mix_targets").collect()
    total = sum(tokens.get(t.source, 0) for t in targets)
    want = {t.source for t in targets if t.max_repeats * tokens.get(t.source, 0) < t.weight * total}
    assert {r.source for r in QUERIES["p7_found"](spark, SF).collect()} == want and want


def test_mix_against_brute_force(spark, library):
    from tallyloom.functions.text import WHITE_SPACE

    rows = QUERIES["p7_mix"](spark, SF).collect()
    targets = {t.source: t for t in read(spark, SF, "mix_targets").collect()}
    sizes, docs = {}, {}
    for r in read(spark, SF, "documents").collect():
        s = r.source.strip(WHITE_SPACE).lower() if r.source is not None else None
        if s in targets:
            docs.setdefault(s, []).append((r.doc_id, len(library(r.text))))
            sizes[s] = sizes.get(s, 0) + docs[s][-1][1]
    budget = sum(sizes.values())
    # In order, each appearance once, copies up to the cap, sizes right, within the budget, short of it by less than a document.
    assert [r.finish_time for r in rows] == sorted(r.finish_time for r in rows)
    seen, own, total = {}, {}, 0
    for r in rows:
        seen.setdefault((r.source, r.doc_id), []).append(r.copy_no)
        own[r.source] = own.get(r.source, 0) + r.n_tokens
        total += r.n_tokens
        assert r.mix_end == total and (r.doc_id, r.n_tokens) in docs[r.source]
        assert abs(r.finish_time * targets[r.source].weight - own[r.source]) < 1e-6 * own[r.source] + 1e-9
    assert all(sorted(v) == [*range(1, len(v) + 1)] and len(v) <= targets[s].max_repeats for (s, _), v in seen.items())
    largest = max(n for d in docs.values() for _, n in d)
    assert budget - largest < total <= budget
    # Whoever isn't exhausted has its share of the virtual time that has passed.
    end = rows[-1].finish_time
    shares = {r.source: r for r in QUERIES["p7_shares"](spark, SF).collect()}
    for s, t in targets.items():
        capacity = sizes.get(s, 0) * t.max_repeats
        assert shares[s].mix_tokens == own.get(s, 0) and abs(shares[s].share - own.get(s, 0) / total) < 1e-9
        assert own.get(s, 0) <= min(capacity, t.weight * end + 1e-6) and own.get(s, 0) > min(capacity, t.weight * end) - largest - 1
        assert shares[s].is_exhausted == (own.get(s, 0) == capacity)


def test_sentences_cover_the_documents(spark):
    texts = {r.doc_id: r.text for r in read(spark, SF, "documents").collect()}
    got = {}
    for r in QUERIES["p8_sentences"](spark, SF).collect():
        got.setdefault(r.doc_id, []).append((r.start_at, r.end_at))
    assert set(got) == {k for k, t in texts.items() if t and t.strip()}
    for k, places in got.items():
        rest = list(texts[k])
        for a, b in places:
            assert texts[k][a:b] == texts[k][a:b].strip()
            rest[a:b] = [" "] * (b - a)
        assert "".join(rest).strip() == ""
