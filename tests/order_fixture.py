"""A small order-entry database made from rules, with the awkward cases put in by hand."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession

from starmill.schemas.order_entry import ORDER_ENTRY

FIRST = dt.date(2021, 3, 1)


def rows() -> dict[str, list[dict]]:
    categories = [
        dict(category_id=i, category_name=f"cat {i}", description=None, picture=b"")
        for i in (1, 2, 3)
    ]
    suppliers = [
        dict(supplier_id=i, company_name=f"sup {i}", city="Oslo", region=None if i % 2 else "N")
        for i in range(1, 6)
    ]
    customers = [
        dict(customer_id=f"C{i:03}", company_name=f"cust {i}", country="NO", region=None)
        for i in range(20)
    ]
    products = [
        dict(
            product_id=i,
            product_name=f"prod {i}",
            supplier_id=1 + i % 5 if i != 4 else None,
            category_id=1 + i % 3 if i != 7 else None,
            unit_price=i * 1.1,
            units_in_stock=i,
            reorder_level=10,
            discontinued=i % 2,
        )
        for i in range(1, 31)
    ]
    employees = [
        dict(employee_id=1, last_name="Berg", first_name="Ada", title="Boss", hire_date=FIRST),
        dict(employee_id=2, last_name="Lund", first_name="Bo", title=None, hire_date=None, reports_to=1),
        dict(employee_id=3, last_name="Vik", first_name="Cy", title="Clerk", hire_date=FIRST, reports_to=1),
    ]
    region = [dict(region_id=i, region_description=d) for i, d in ((1, "East"), (2, "West"))]
    territories = [
        dict(territory_id=f"0{i}", territory_description=f"t{i}", region_id=1 + i % 2)
        for i in range(1, 7)
    ]
    # employee 1 works in both regions, employee 3 nowhere
    bridge = [dict(employee_id=1, territory_id=f"0{i}") for i in (1, 2, 3)]
    bridge += [dict(employee_id=2, territory_id=f"0{i}") for i in (2, 4)]
    orders = [
        dict(
            order_id=100 + i,
            customer_id=f"C{i % 18:03}",
            employee_id=1 + i % 3,
            order_date=FIRST + dt.timedelta(i % 40) if i != 5 else None,
            required_date=FIRST + dt.timedelta(i % 40 + 28),
            shipped_date=None if i % 4 == 0 else FIRST + dt.timedelta(i % 40 + 3),
        )
        for i in range(120)
    ]
    # order 107 owns a third of the lines; order 999 does not exist; order 110 has no line
    details = []
    for i in range(120):
        if i == 10:
            continue
        n = 30 if i == 7 else 1 + i % 3
        for p in range(1, n + 1):
            details.append(
                dict(order_id=100 + i, product_id=p, unit_price=p * 1.25, quantity=1 + i % 9,
                     discount=(i % 4) * 0.05)
            )
    details.append(dict(order_id=999, product_id=1, unit_price=2.0, quantity=3, discount=0.0))
    return dict(
        categories=categories, suppliers=suppliers, customers=customers, products=products,
        employees=employees, region=region, territories=territories,
        employee_territories=bridge, orders=orders, order_details=details,
    )


def tables(spark: SparkSession) -> dict[str, DataFrame]:
    made = rows()
    return {
        name: table.rows(
            spark, [tuple(r.get(f.name) for f in table.fields) for r in made.get(name, [])]
        )
        if made.get(name)
        else table.empty(spark)
        for name, table in ORDER_ENTRY.items()
    }
