"""The sample star: two batches of raw rows and the tables that must come out of them."""

from datetime import date
from decimal import Decimal

HEADERS = {
    "customers": "customer_id,customer_name,email,address,city,country,segment",
    "products": "product_id,product_name,category,subcategory,unit_price",
    "orders": "order_id,customer_id,order_date,status",
    "order_lines": "order_id,line_id,product_id,quantity,unit_price,discount_pct",
}

# The sample input.
BATCHES = {
    "batch_1": {
        "customers": """\
1,Alice Johnson,alice@example.com,123 Main St,Copenhagen,Denmark,Premium
2,Bob Smith,bob@example.com,456 Oak Ave,Stockholm,Sweden,Standard
3,Carol Williams,carol@example.com,789 Pine Rd,Oslo,Norway,Premium
4,David Brown,david@example.com,321 Elm St,Helsinki,Finland,Standard
5,Eva Martinez,eva@example.com,654 Birch Ln,Copenhagen,Denmark,Premium
""",
        "products": """\
101,Widget A,Electronics,Gadgets,29.99
102,Widget B,Electronics,Accessories,14.99
103,Gizmo X,Home,Kitchen,49.99
104,Gizmo Y,Home,Garden,34.99
105,Thingamajig,Office,Supplies,9.99
""",
        "orders": """\
1001,1,2024-01-15,completed
1002,2,2024-01-16,completed
1003,3,2024-01-17,completed
1004,1,2024-02-01,completed
1005,4,2024-02-10,shipped
1006,5,2024-02-15,completed
1007,2,2024-03-01,pending
""",
        "order_lines": """\
1001,1,101,2,29.99,0
1001,2,105,5,9.99,10
1002,1,103,1,49.99,0
1003,1,102,3,14.99,5
1003,2,104,1,34.99,0
1004,1,101,1,29.99,15
1005,1,105,10,9.99,20
1006,1,103,2,49.99,0
1006,2,102,1,14.99,0
1007,1,104,2,34.99,0
""",
    },
    "batch_2": {
        "customers": """\
2,Bob Smith,bob.smith@newmail.com,456 Oak Ave,Stockholm,Sweden,Premium
5,Eva Martinez,eva@example.com,100 New Street,Aarhus,Denmark,Premium
6,Frank Lee,frank@example.com,200 Maple Dr,Gothenburg,Sweden,Standard
""",
        "orders": """\
1005,4,2024-02-10,completed
1008,6,2024-03-15,completed
""",
        "order_lines": """\
1008,1,101,1,29.99,0
""",
    },
}

FIRST, SECOND, OPEN = date(2024, 1, 1), date(2024, 3, 1), date(9999, 12, 31)
CLOSED = date(2024, 2, 29)
DATES = {"batch_1": FIRST, "batch_2": SECOND}

_ALICE = (1, "Alice Johnson", "alice@example.com", "123 Main St", "Copenhagen", "DENMARK")
_BOB_1 = (2, "Bob Smith", "bob@example.com", "456 Oak Ave", "Stockholm", "SWEDEN", "Standard")
_BOB_2 = (2, "Bob Smith", "bob.smith@newmail.com", "456 Oak Ave", "Stockholm", "SWEDEN", "Premium")
_CAROL = (3, "Carol Williams", "carol@example.com", "789 Pine Rd", "Oslo", "NORWAY", "Premium")
_DAVID = (4, "David Brown", "david@example.com", "321 Elm St", "Helsinki", "FINLAND", "Standard")
_EVA_1 = (5, "Eva Martinez", "eva@example.com", "654 Birch Ln", "Copenhagen", "DENMARK", "Premium")
_EVA_2 = (5, "Eva Martinez", "eva@example.com", "100 New Street", "Aarhus", "DENMARK", "Premium")
_FRANK = (6, "Frank Lee", "frank@example.com", "200 Maple Dr", "Gothenburg", "SWEDEN", "Standard")

DIM_CUSTOMER = [
    (1, *_ALICE, "Premium", FIRST, OPEN, True),
    (2, *_BOB_1, FIRST, CLOSED, False),
    (3, *_BOB_2, SECOND, OPEN, True),
    (4, *_CAROL, FIRST, OPEN, True),
    (5, *_DAVID, FIRST, OPEN, True),
    (6, *_EVA_1, FIRST, CLOSED, False),
    (7, *_EVA_2, SECOND, OPEN, True),
    (8, *_FRANK, SECOND, OPEN, True),
]

DIM_CUSTOMER_HALF_OPEN = [
    (*row[:9], None if row[10] else SECOND) for row in DIM_CUSTOMER
]

DIM_PRODUCT = [
    (1, 101, "Widget A", "Electronics", "Gadgets", Decimal("29.99")),
    (2, 102, "Widget B", "Electronics", "Accessories", Decimal("14.99")),
    (3, 103, "Gizmo X", "Home", "Kitchen", Decimal("49.99")),
    (4, 104, "Gizmo Y", "Home", "Garden", Decimal("34.99")),
    (5, 105, "Thingamajig", "Office", "Supplies", Decimal("9.99")),
]


def _fact(sk, order, line, customer, product, day, quantity, price, pct, amount, status):
    return (
        sk, order, line, customer, product, day, quantity,
        Decimal(price), Decimal(pct), Decimal(amount), status,
    )


FACT = [
    _fact(1, 1001, 1, 1, 1, 20240115, 2, "29.99", "0.00", "59.98", "completed"),
    _fact(2, 1001, 2, 1, 5, 20240115, 5, "9.99", "10.00", "44.96", "completed"),
    _fact(3, 1002, 1, 2, 3, 20240116, 1, "49.99", "0.00", "49.99", "completed"),
    _fact(4, 1003, 1, 4, 2, 20240117, 3, "14.99", "5.00", "42.72", "completed"),
    _fact(5, 1003, 2, 4, 4, 20240117, 1, "34.99", "0.00", "34.99", "completed"),
    _fact(6, 1004, 1, 1, 1, 20240201, 1, "29.99", "15.00", "25.49", "completed"),
    _fact(7, 1005, 1, 5, 5, 20240210, 10, "9.99", "20.00", "79.92", "completed"),
    _fact(8, 1006, 1, 6, 3, 20240215, 2, "49.99", "0.00", "99.98", "completed"),
    _fact(9, 1006, 2, 6, 2, 20240215, 1, "14.99", "0.00", "14.99", "completed"),
    _fact(10, 1007, 1, 3, 4, 20240301, 2, "34.99", "0.00", "69.98", "pending"),
    _fact(11, 1008, 1, 8, 1, 20240315, 1, "29.99", "0.00", "29.99", "completed"),
]


def write_raw(root, batches=BATCHES):
    """The sample input as files below ``root``."""
    for batch, entities in batches.items():
        folder = root / batch
        folder.mkdir(parents=True)
        for entity, text in entities.items():
            (folder / f"{entity}.csv").write_text(f"{HEADERS[entity]}\n{text}")
    return str(root)


def rows(df, *order):
    """Rows as sorted tuples."""
    listed = [tuple(r) for r in df.collect()]
    return sorted(listed, key=lambda r: tuple((v is not None, v) for v in r))
