"""Hand-made raw rows (CSV-shaped: strings) for rule tests."""

from __future__ import annotations

from martlet.sources.schemas import RAW_SCHEMAS

ORDER = ("order_id customer_id order_status order_purchase_timestamp order_approved_at "
         "order_delivered_carrier_date order_delivered_customer_date order_estimated_delivery_date").split()


def orders_row(oid, status="delivered", purchased="2017-05-01 10:00:00", delivered="2017-05-05 10:00:00",
               estimated="2017-05-10 00:00:00", customer="c1", carrier="2017-05-02 10:00:00"):
    return (oid, customer, status, purchased, purchased, carrier, delivered, estimated)


def item_row(oid, seq=1, product="p1", seller="s1", price="10.00", freight="2.00"):
    return (oid, seq, product, seller, "2017-05-03 00:00:00", price, freight)


def review_row(rid, oid, score, created="2017-05-06 00:00:00"):
    return (rid, oid, score, None, None, created, created)


def raw_tables(spark, orders, items, reviews=(), payments=(), customers=None, products=None, sellers=None,
               translation=None, geolocation=()):
    customers = customers if customers is not None else [("c1", "u1", "01000", "sao paulo", "SP"),
                                                         ("c2", "u1", "02000", "rio", "RJ")]
    products = products if products is not None else [("p1", "cat_a", None, None, None, 1.0, 1.0, 1.0, 1.0),
                                                      ("p2", None, None, None, None, 1.0, 1.0, 1.0, 1.0)]
    sellers = sellers if sellers is not None else [("s1", "01000", "sao paulo", "SP")]
    translation = translation if translation is not None else [("cat_a", "category a")]
    data = {"orders": orders, "order_items": items, "order_reviews": list(reviews),
            "order_payments": list(payments), "customers": customers, "products": products,
            "sellers": sellers, "category_name_translation": translation, "geolocation": list(geolocation)}
    return {k: spark.createDataFrame(v, RAW_SCHEMAS[k]) for k, v in data.items()}
