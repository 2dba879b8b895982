"""The field against exact inference on small graphs, and what its skip edges change."""

import itertools

import numpy as np
import pytest

from wellspan.llm import pii

N = len(pii.LABELS)


def exact(field, found):
    """Marginals by summing over all labels of all tokens and hubs."""
    n, hubs = len(found.spans), len(found.hubs)
    node = np.zeros((n, N))
    for i, fs in enumerate(found.features):
        node[i] = field.node[[field.names[f] for f in fs if f in field.names]].sum(axis=0)
        if found.seen[i] > 0 and not found.base[i]:
            node[i, found.seen[i]] += field.agree[found.seen[i]]
    total = np.zeros((n, N))
    for labels in itertools.product(range(N), repeat=n + hubs):
        if any(y and labels[i] != y for i, y in enumerate(found.base)):
            continue
        z = sum(node[i, labels[i]] for i in range(n) if not found.base[i])
        z += sum(field.step[labels[i], labels[j]] for i, j in found.chain)
        z += sum(field.agree.min() * (labels[i] == labels[n + h]) for h, members in enumerate(found.hubs) for i in members)
        for i in range(n):
            total[i, labels[i]] += np.exp(z)
    return total / total.sum(axis=1, keepdims=True)


@pytest.mark.parametrize(
    "text",
    [
        "call 5245557373 or 5245557373",  # one hub
        "+15245557373 and 5245557373 then 77",  # an observed hub and a chain
        "7 8 9",
        "write to jane.doe@x.com, as jane.doe said 12",
    ],
)
def test_messages_are_exact_on_trees(text):
    rng = np.random.default_rng(11)
    found = pii.tokens_of(text, pii.base_spans(text))
    names = {f: i for i, f in enumerate(sorted({f for fs in found.features for f in fs}))}
    field = pii.Field(names, rng.normal(size=(len(names), N)), rng.normal(size=(N, N)), rng.uniform(0.5, 2, N))
    assert found.spans and np.abs(field.marginals(found) - exact(field, found)).max() < 0.01


def test_skip_edges_change_results(spark):
    rng = np.random.default_rng(12)
    number = lambda n: "".join(map(str, rng.integers(1, 10, n)))
    texts = [f"call +{number(11)} or first.last{i}@mail.example.com about order {number(10)}" for i in range(200)]
    field = pii.fit(spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string"))
    loose = pii.Field(field.names, field.node, field.step, np.zeros(N))
    text = "call +15245557373 now" + ", again 5245557373" * 3
    assert len(field.further(text, pii.base_spans(text))) == 3 and loose.further(text, pii.base_spans(text)) == []
    # What they share is learned, and long tokens and contexts are read whole.
    assert (field.agree[[1, 4]] > 0.5).all()
    far = "x" * 500
    assert pii.described("1" + "a1" * 40, far, far)[1] == "shape <1>" + "a<1>" * 40 and pii.word_before(far + " ", 501) == far


def test_odd_rows(spark):
    rows = [(1, "a.b@c.de"), (1, "a.b@c.de"), (None, "+1 (524) 555-7373"), (2, None), (2, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = pii.find(df, pii.fit(df), ["doc_id"]).collect()
    assert sorted((str(r["doc_id"]), r["spans"], r["n_spans"]) for r in got) == [("1", "email:0:8", 1), ("1", "email:0:8", 1), ("2", "", 0), ("2", "", 0), ("None", "phone:0:17", 1)]
