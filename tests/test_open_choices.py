"""First free product and number of free ones, against plain sets."""

from __future__ import annotations

import random

import pytest

from tallyhouse.operators import customers
from tallyhouse.operators.customers import first_gaps, open_choices


def test_gaps_of_every_shape(spark):
    word, chunk = customers.WORD, customers.CHUNK * customers.WORD
    shapes = {
        1: range(1, 2), 2: range(2, 9), 3: range(1, word + 1), 4: range(1, word), 5: [*range(1, word + 1), word + 3], 6: range(1, chunk + 1),
        7: [*range(1, chunk + 1), *range(2 * chunk + 1, 2 * chunk + 9)], 8: range(chunk + 1, chunk + 5), 9: range(1, 2 * chunk + 1),
        10: [*range(1, chunk + 1), *range(chunk + 1, chunk + 8), chunk + 9], 11: [*range(1, 5 * word + 1), *range(6 * word + 1, 7 * word + 1)],
    }
    rows = [(owner, n) for owner, numbers in shapes.items() for n in numbers]
    found = first_gaps(spark.createDataFrame(rows + rows[:500], "o long, n long"), "o", "n").collect()
    expected = {}
    for owner, numbers in shapes.items():
        own = set(numbers)
        expected[owner] = (len(own), next(k for k in range(1, max(own) + 2) if k not in own))
    assert {r.o: (r.owned, r.gap) for r in found} == expected


@pytest.mark.parametrize("seed", range(2))
def test_choices_equal_sets(spark, monkeypatch, seed):
    monkeypatch.setattr(customers, "WORD", 3)
    monkeypatch.setattr(customers, "CHUNK", 2)
    draw = random.Random(seed)
    products = [(draw.randrange(10**12), draw.random() < 0.8) for _ in range(40)]
    active = sorted({p for p, on in products if on})
    owned = [(draw.randrange(12), draw.choice(active[: draw.randrange(1, len(active) + 1)])) for _ in range(400)]
    owned += [(99, p) for p in active] + [(98, p) for p in active[:-1]] + [(None, active[0])]
    owners = [(o,) for o in (*range(14), 98, 99)]
    found = open_choices(
        spark.createDataFrame(owners, "id long"), spark.createDataFrame(owned, "cart_id long, product_id long"), "cart_id",
        spark.createDataFrame(list({p: on for p, on in products}.items()), "id long, is_active boolean"),
    ).collect()
    active = sorted(p for p, on in {p: on for p, on in products}.items() if on)
    for row in found:
        free = [p for p in active if (row.cart_id, p) not in set(owned)]
        assert (row.open_products, row.first_product_id) == (len(free), min(free, default=None)), row
    assert len(found) == len(owners)
