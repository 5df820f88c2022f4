"""The order-entry source: 14 tables that feed the star schema.

Names, types, lengths and keys are fixed values.
"""

from __future__ import annotations

from starmill.schemas.tables import Table, binary, by_name, date, number, small, text, to, whole

_ADDRESS = (
    text("address", 60),
    text("city", 15),
    text("region", 15),
    text("postal_code", 10),
    text("country", 15),
)
_COMPANY = (
    text("company_name", 40, required=True),
    text("contact_name", 30),
    text("contact_title", 30),
    *_ADDRESS,
    text("phone", 24),
    text("fax", 24),
)

ORDER_ENTRY = by_name(
    Table(
        "categories",
        (
            small("category_id", True),
            text("category_name", 15, True),
            text("description"),
            binary("picture"),
        ),
        key=("category_id",),
    ),
    Table(
        "customer_demographics",
        (text("customer_type_id", required=True), text("customer_desc")),
        key=("customer_type_id",),
    ),
    Table("customers", (text("customer_id", required=True), *_COMPANY), key=("customer_id",)),
    Table(
        "customer_customer_demo",
        (text("customer_id", required=True), text("customer_type_id", required=True)),
        key=("customer_id", "customer_type_id"),
        references=(to("customer_demographics", "customer_type_id"), to("customers", "customer_id")),
    ),
    Table(
        "employees",
        (
            small("employee_id", True),
            text("last_name", 20, True),
            text("first_name", 10, True),
            text("title", 30),
            text("title_of_courtesy", 25),
            date("birth_date"),
            date("hire_date"),
            *_ADDRESS,
            text("home_phone", 24),
            text("extension", 4),
            binary("photo"),
            text("notes"),
            small("reports_to"),
            text("photo_path", 255),
        ),
        key=("employee_id",),
        references=(to("employees", "reports_to", "employee_id"),),
    ),
    Table(
        "suppliers",
        (small("supplier_id", True), *_COMPANY, text("homepage")),
        key=("supplier_id",),
    ),
    Table(
        "products",
        (
            small("product_id", True),
            text("product_name", 40, True),
            small("supplier_id"),
            small("category_id"),
            text("quantity_per_unit", 20),
            number("unit_price"),
            small("units_in_stock"),
            small("units_on_order"),
            small("reorder_level"),
            whole("discontinued", True),
        ),
        key=("product_id",),
        references=(to("categories", "category_id"), to("suppliers", "supplier_id")),
    ),
    Table(
        "region",
        (small("region_id", True), text("region_description", required=True)),
        key=("region_id",),
    ),
    Table(
        "shippers",
        (small("shipper_id", True), text("company_name", 40, True), text("phone", 24)),
        key=("shipper_id",),
    ),
    Table(
        "orders",
        (
            small("order_id", True),
            text("customer_id"),
            small("employee_id"),
            date("order_date"),
            date("required_date"),
            date("shipped_date"),
            small("ship_via"),
            number("freight"),
            text("ship_name", 40),
            text("ship_address", 60),
            text("ship_city", 15),
            text("ship_region", 15),
            text("ship_postal_code", 10),
            text("ship_country", 15),
        ),
        key=("order_id",),
        references=(
            to("customers", "customer_id"),
            to("employees", "employee_id"),
            to("shippers", "ship_via", "shipper_id"),
        ),
    ),
    Table(
        "territories",
        (
            text("territory_id", 20, True),
            text("territory_description", required=True),
            small("region_id", True),
        ),
        key=("territory_id",),
        references=(to("region", "region_id"),),
    ),
    Table(
        "employee_territories",
        (small("employee_id", True), text("territory_id", 20, True)),
        key=("employee_id", "territory_id"),
        references=(to("territories", "territory_id"), to("employees", "employee_id")),
    ),
    Table(
        "order_details",
        (
            small("order_id", True),
            small("product_id", True),
            number("unit_price", True),
            small("quantity", True),
            number("discount", True),
        ),
        key=("order_id", "product_id"),
        references=(to("products", "product_id"), to("orders", "order_id")),
    ),
    Table(
        "us_states",
        (
            small("state_id", True),
            text("state_name", 100),
            text("state_abbr", 2),
            text("state_region", 50),
        ),
        key=("state_id",),
    ),
)
