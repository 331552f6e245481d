"""What a Python worker carries from the tasks of one operator to those of the next."""

import gc
import weakref

import pytest

from eventlayers.llm import bpe, sigtree, toxicity


@pytest.mark.parametrize(
    "start",
    [lambda: list(sigtree.new_classes(iter(()))), lambda: list(toxicity.scored(toxicity.Network({}), 1, iter(())))],
    ids=["near_copies", "toxicity"],
)
def test_tasks_let_go_what_other_operators_kept(start):
    codec = weakref.ref(bpe.encoder(bpe.default_vocabulary()))
    start()
    gc.collect()
    assert codec() is None


def test_tasks_of_one_operator_share_an_encoder():
    assert bpe.encoder(bpe.default_vocabulary()) is bpe.encoder(bpe.default_vocabulary())
