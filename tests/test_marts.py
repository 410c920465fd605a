import datetime as dt
import random
from collections import defaultdict
from decimal import Decimal

from conftest import rows

from spanledger.operators.marts import contracts_by_month, date_spine, fct_contract_metrics
from spanledger.workloads.views import territory_reference

OPEN_DAY = dt.date(9999, 12, 31)


def test_month_spine(spark):
    spine = date_spine(spark, "2022-01-01", "2022-04-01")
    assert [str(r.effective_date) for r in spine.collect()] == ["2022-01-01", "2022-02-01", "2022-03-01"]
    assert [str(r.month_end_date) for r in spine.collect()] == ["2022-01-31", "2022-02-28", "2022-03-31"]
    assert date_spine(spark, "2022-01-01", "2022-04-02").count() == 4
    assert date_spine(spark, "2022-01-01", "2022-01-01").count() == 0
    assert date_spine(spark, "2022-01-30", "2022-03-01", "day").count() == 30


def random_dim(seed):
    rnd = random.Random(seed)
    out = []
    for _ in range(300):
        start = dt.date(2021, 9, 1) + dt.timedelta(days=rnd.randrange(500))
        end = rnd.choice([OPEN_DAY, start + dt.timedelta(days=rnd.randrange(200)), start])
        amount = rnd.choice([None, Decimal(rnd.randrange(100_000)).scaleb(-2)])
        out.append((rnd.randrange(40), 1, 100 + rnd.randrange(9), "E", amount, start, start, end))
    return out


DIM = ("contract_identifier long, contract_id long, territory_id long, external_contract_id string, "
       "amount decimal(12,2), interest_date date, effective_from_date date, effective_to_date date")


def test_fact_against_the_plain_range_join(spark):
    data = random_dim(1)
    # Steps that start on the first of a month and in its middle.
    for start, end in (("2022-01-01", "2022-08-01"), ("2022-01-15", "2022-06-20")):
        steps = [r.effective_date for r in date_spine(spark, start, end).orderBy("effective_date").collect()]
        groups, detail = defaultdict(list), []
        for step in steps:
            for i, _, territory, _, amount, _, f, t in data:
                if f <= step <= t:
                    groups[step, territory].append((i, amount))
                    detail.append((step, i, territory, amount))
        expected = {}
        for k, members in groups.items():
            amounts = [a for _, a in members if a is not None]
            expected[k] = (len({i for i, _ in members}), sum(amounts) if amounts else None,
                           min(amounts, default=None), max(amounts, default=None))
        dim = spark.createDataFrame(data, DIM)
        fact = fct_contract_metrics(dim, territory_reference(spark), start, end).collect()
        found = {(r.effective_date, r.territory_id): (r.contract_count, r.total_amount, r.min_amount, r.max_amount)
                 for r in fact}
        assert found == expected and len(fact) == len(expected)
        for r in fact:
            assert r.effective_month == r.effective_date.replace(day=1)
            assert (r.territory_name is None) == (r.territory_id > 106)
            amounts = [a for _, a in groups[r.effective_date, r.territory_id] if a is not None]
            if amounts:
                assert abs(r.avg_amount - sum(amounts) / len(amounts)) < Decimal("1e-12")
        months = contracts_by_month(dim, start, end)
        assert rows(months, "effective_date", "contract_identifier", "territory_id", "amount") == sorted(detail, key=str)


def test_fact_of_double_amounts_and_no_rows(spark):
    dim = spark.createDataFrame(random_dim(2)[:50], DIM)
    doubles = dim.withColumn("amount", dim.amount.cast("double"))
    assert fct_contract_metrics(doubles, territory_reference(spark), "2022-01-01", "2022-03-01").count() > 0
    assert fct_contract_metrics(dim.limit(0), territory_reference(spark), "2022-01-01", "2022-03-01").count() == 0
