"""Sales operators against a pure-Python brute force on random small inputs."""

import datetime as dt
from collections import defaultdict
from decimal import Decimal

from hypothesis import given, settings, strategies as st

from cartwheel.operators import sales

ORDER_COLS = "order_id long, customer_id long, product_id long, quantity long, order_date date"
PRODUCT_COLS = "product_id long, category string, price double"

DATES = [None, dt.date(2024, 1, 5), dt.date(2024, 1, 20), dt.date(2024, 3, 2),
         dt.date(2024, 4, 30)]

order_rows = st.lists(st.tuples(
    st.one_of(st.none(), st.integers(1, 50)),            # order_id
    st.one_of(st.none(), st.integers(1, 6)),             # customer_id
    st.one_of(st.none(), st.integers(1, 8)),             # product_id (7, 8 unknown)
    st.integers(1, 10),                                  # quantity
    st.sampled_from(DATES)), min_size=1, max_size=30)
prices = st.lists(st.integers(0, 50000), min_size=6, max_size=6)   # cents, 0 allowed


def _money(cents):
    return float(Decimal(cents) / 100)


@settings(max_examples=12, deadline=None)
@given(order_rows, prices)
def test_sales_match_brute_force(spark, rows, cents):
    products = [(i + 1, f"c{i % 3}", c / 100) for i, c in enumerate(cents)]
    price = {i + 1: Decimal(c) for i, c in enumerate(cents)}      # in cents
    category = {pid: cat for pid, cat, _ in products}
    o = spark.createDataFrame(rows, ORDER_COLS)
    p = spark.createDataFrame(products, PRODUCT_COLS)

    inner = [(oid, cid, pid, q, d) for oid, cid, pid, q, d in rows if pid in price]

    # top customers (inner join)
    rev, cnt = defaultdict(Decimal), defaultdict(int)
    for oid, cid, pid, q, d in inner:
        rev[cid] += q * price[pid]
        cnt[cid] += oid is not None
    expected = sorted(((c, _money(r), cnt[c], (_money(r) / cnt[c]) if cnt[c] else None)
                       for c, r in rev.items()),
                      key=lambda t: (-t[1], t[0] is not None, t[0] or 0))[:10]
    got = [tuple(r) for r in sales.top_customers_by_revenue(o, p, 10).collect()]
    assert got == expected

    # sales by category
    agg = defaultdict(lambda: [Decimal(0), 0, Decimal(0), 0, 0])
    for oid, cid, pid, q, d in inner:
        a = agg[category[pid]]
        a[0] += q * price[pid]
        a[1] += q
        a[2] += price[pid]
        a[3] += 1
        a[4] += oid is not None
    expected = {k: (_money(a[0]), a[1], _money(a[2]) / a[3], a[4]) for k, a in agg.items()}
    got = {r.category: tuple(r)[1:] for r in sales.sales_by_category(o, p).collect()}
    assert got == expected

    # monthly trends
    months = defaultdict(Decimal)
    for oid, cid, pid, q, d in inner:
        months[d.replace(day=1) if d else None] += q * price[pid]
    order = sorted(months, key=lambda m: (m is not None, m or dt.date.min))
    expected, prev = [], None
    for m in order:
        cur = _money(months[m])
        growth = None if prev in (None, 0.0) else (cur - prev) / prev * 100
        expected.append((m, cur, prev, growth))
        prev = cur
    got = sorted((tuple(r) for r in sales.monthly_trends(o, p).collect()),
                 key=lambda t: (t[0] is not None, t[0] or dt.date.min))
    assert got == expected

    # left-join variants
    left = defaultdict(lambda: None)
    for oid, cid, pid, q, d in rows:
        if cid not in left:
            left[cid] = None
        if pid in price:
            left[cid] = (left[cid] or Decimal(0)) + q * price[pid]
    got = {r.customer_id: r.total_revenue
           for r in sales.customer_revenue_left(o, p, 100).collect()}
    assert got == {c: (_money(v) if v is not None else None) for c, v in left.items()}
    got_zero = {r.customer_id: r.revenue
                for r in sales.customer_revenue_left_zero(o, p, 100).collect()}
    assert got_zero == {c: (_money(v) if v is not None else 0.0)
                        for c, v in left.items() if c is not None}


fractional = st.one_of(st.none(), st.floats(-100, 100), st.integers(0, 40).map(lambda n: n / 4),
                       st.sampled_from([1e-9, 1e17, 2e6, float("inf"), float("nan")]))
four_places = st.one_of(st.none(), st.integers(0, 10 ** 7).map(lambda n: n / 10 ** 4),
                        st.sampled_from([1e17, 0.1 + 0.2, float("inf"), float("nan"), 1e-12]))


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 3), st.integers(1, 5), fractional), min_size=1, max_size=25),
       st.lists(four_places, min_size=4, max_size=4))
def test_fractional_and_non_finite_revenue(spark, rows, price_list):
    import math
    orders = spark.createDataFrame([(1, c, p, q, None) for c, p, q in rows],
                                   ORDER_COLS.replace("quantity long", "quantity double"))
    products = spark.createDataFrame([(i + 1, "c", p) for i, p in enumerate(price_list)], PRODUCT_COLS)
    want = {}
    for c, p, q in rows:
        if p <= 4:
            want.setdefault(c, [])
            if q is not None and price_list[p - 1] is not None:
                want[c].append(q * price_list[p - 1])
    got = {r.customer_id: r.total_revenue for r in sales.top_customers_by_revenue(orders, products, None).collect()}
    assert got.keys() == want.keys()
    for c, values in want.items():
        if not values:
            assert got[c] is None
        elif all(map(math.isfinite, values)):
            assert math.isclose(got[c], math.fsum(values), rel_tol=1e-12, abs_tol=1e-9 * max(map(abs, values)))
        else:
            total = sum(values)
            assert got[c] == total or math.isnan(got[c]) and math.isnan(total)


def test_probe_lines_are_exact_and_layout_independent(spark):
    lines = [(1, 1, 1, 1.5, None), (2, 1, 2, 1000.0, None), (3, 2, 3, 0.25, None)]
    orders = spark.createDataFrame(lines, ORDER_COLS.replace("quantity long", "quantity double"))
    products = spark.createDataFrame([(1, "a", 10.0), (2, "a", 0.0035), (3, "b", 8.0)], PRODUCT_COLS)
    got = {r.customer_id: r.total_revenue for r in sales.top_customers_by_revenue(orders, products).collect()}
    assert got == {1: 18.5, 2: 2.0}
    units = {r.category: r.total_units_sold for r in sales.sales_by_category(orders, products).collect()}
    assert units == {"a": 1001.5, "b": 0.25}
    many = spark.createDataFrame([(i, i % 3, 2, (i % 7) / 4, None) for i in range(500)],
                                 ORDER_COLS.replace("quantity long", "quantity double"))
    one, two = (sorted(map(tuple, sales.top_customers_by_revenue(many.repartition(n), products, None).collect()))
                for n in (1, 7))
    assert one == two
