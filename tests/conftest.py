import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from clientele.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    return local_session(cpus=8, shuffle_partitions=8)


@pytest.fixture
def shop(spark):
    """Small hand-made tables with one planted defect per rule."""

    def df(rows, schema):
        return spark.createDataFrame(rows, schema)

    return {
        "users": df([(1, "Ann")], "id bigint, given_name string"),
        "pipelines": df([(1, "Sales")], "id bigint, name string"),
        "stages": df(
            [(1, "New", 1), (2, "Lost", 9), (3, None, None)],
            "id bigint, name string, pipeline_id bigint",
        ),
        "tags": df([(1, "A"), (2, "B")], "id bigint, name string"),
        "companies": df([(1, "Acme"), (2, ""), (3, None)], "id bigint, name string"),
        "contacts": df(
            [
                (1, 1, 1, "Ann", "A", "a@x", '[{"email":"A@x","field":"EMAIL1"}]', '{"email_addresses":[1]}'),
                (2, 7, 1, "", None, "a@x", '[{"email":"a@X","field":"Work"},{"email":"z","field":"HOME"}]', "{}"),
                (3, None, 8, "Cy", "", None, "[]", '{"email_addresses":[]}'),
                (4, 1, None, None, "", "b@x", None, '{"email_addresses":null}'),
            ],
            "id bigint, company_id bigint, owner_id bigint, given_name string, family_name string,"
            " email string, email_addresses string, raw string",
        ),
        "contact_tags": df(
            [(1, 1), (1, 9), (99, 1), (None, 2)], "contact_id bigint, tag_id bigint"
        ),
        "opportunities": df(
            [(1, 1, 1, 1, 1, 1, 10.0), (2, 5, None, None, None, None, 5.0), (3, 1, 9, 1, 8, 7, 1.0), (4, None, None, 1, 2, 2, 1.0)],
            "id bigint, contact_id bigint, company_id bigint, owner_id bigint, stage_id bigint,"
            " pipeline_id bigint, value double",
        ),
        "tasks": df(
            [(1, 1, 1, 1, "call"), (2, 77, None, None, None), (3, None, 77, None, "x"), (4, None, None, 5, "y")],
            "id bigint, contact_id bigint, opportunity_id bigint, owner_id bigint, title string",
        ),
        "notes": df(
            [(1, 1, 1, 1, "ok"), (2, 77, 1, 1, "b" * 150), (3, None, 66, 1, "z"), (4, 78, 1, 1, "short")],
            "id bigint, contact_id bigint, opportunity_id bigint, owner_id bigint, body string",
        ),
        "products": df([(1, "P")], "id bigint, name string"),
        "orders": df(
            [(1, 1, "100.00"), (2, 55, "50.00"), (3, None, "7.00"), (4, 1, "10.00")],
            "id bigint, contact_id bigint, total string",
        ).selectExpr("id", "contact_id", "CAST(total AS DECIMAL(15,2)) AS total"),
        "order_items": df(
            [(1, 1, 1, "i", "50.00", "2.00", None), (2, 2, 9, "j", "25.00", "2.00", "50.02"), (3, 44, 1, None, "1.00", "1.00", None), (3, 4, 1, "k", "5.00", "2.00", "10.01")],
            "id bigint, order_id bigint, product_id bigint, name string, unit_price string,"
            " quantity string, subtotal string",
        ).selectExpr(
            "id", "order_id", "product_id", "name", "CAST(unit_price AS DECIMAL(15,2)) AS unit_price",
            "CAST(quantity AS DECIMAL(10,2)) AS quantity", "CAST(subtotal AS DECIMAL(15,2)) AS subtotal",
        ),
        "payments": df(
            [(1, 1, "100.01"), (2, 2, "60.00"), (3, 33, "1.00"), (4, 4, None)],
            "id bigint, order_id bigint, amount string",
        ).selectExpr("id", "order_id", "CAST(amount AS DECIMAL(15,2)) AS amount"),
    }
