"""Small raw CSV fixtures for the marketplace warehouse (own rows).

They carry the edge cases the models must handle: a recode with a leading
space, an unapproved order, a delivery before purchase, a 23:00 -> 01:00
delivery, an order without customer, several payment types incl. an unlisted
one, duplicate and shared reviews, accented / hyphenated / NBSP / ``ß`` names,
lookup chains, leading-zero postcodes, fractional integer casts, a zero area.
"""

from __future__ import annotations

import csv
import os

NBSP = " "

MARKETPLACE = {
    "customers.csv": (
        ["customer_id", "customer_unique_id", "customer_zip_code_prefix", "customer_city", "customer_state"],
        [
            ["b1", "u1", "01307", "são paulo", "SP"],
            ["b2", "u1", "04004", "Sao Paulo", "SP"],
            ["b3", "u1", "12345", "  d'oeste ", "RO"],
            ["b4", "u2", "22222", "alta floresta do oeste", "RO"],
            ["b5", "u3", "33333", "lages sc", "SC"],
            ["b6", "u4", "44444", "straße", "RS"],
            ["b7", "u5", "55555", f"{NBSP}abrantes{NBSP}", "BA"],
            ["b8", "u6", "66666", "Santa-Rita", "PB"],
        ]),
    "orders.csv": (
        ["order_id", "customer_id", "order_status", "order_purchase_timestamp", "order_approved_at",
         "order_delivered_carrier_date", "order_delivered_customer_date", "order_estimated_delivery_date"],
        [
            ["o1", "b1", "delivered", "2017-01-10 10:00:00", "2017-01-10 11:00:00", "2017-01-11 08:00:00",
             "2017-01-15 09:00:00", "2017-01-20 00:00:00"],
            ["o2", "b2", "canceled", "2017-01-10 10:00:00", "2017-01-10 12:00:00", "", "", "2017-01-25 00:00:00"],
            ["o3", "b3", " canceled", "2017-03-01 08:00:00", "", "", "", "2017-03-20 00:00:00"],
            ["o4", "b4", "delivered", "2017-02-01 23:00:00", "2017-02-02 01:00:00", "2017-02-02 00:30:00",
             "2017-02-02 01:00:00", "2017-02-10 00:00:00"],
            ["o5", "b5", "delivered", "2017-05-05 12:00:00", "2017-05-05 13:00:00", "2017-05-04 10:00:00",
             "2017-05-04 12:00:00", "2017-05-20 00:00:00"],
            ["o6", "b99", "shipped", "2017-06-01 09:00:00", "2017-06-01 10:00:00", "2017-06-02 10:00:00", "",
             "2017-06-20 00:00:00"],
            ["o7", "b6", "delivered", "2017-07-01 09:00:00", "2017-07-01 10:00:00", "2017-07-02 10:00:00",
             "2017-07-05 18:00:00", "2017-07-10 00:00:00"],
            ["o8", "b7", "invoiced", "2017-08-01 09:00:00", "2017-08-01 10:00:00", "", "", "2017-08-20 00:00:00"],
            ["o9", "b8", "processing", "2017-08-02 09:00:00", "2017-08-02 10:00:00", "", "",
             "2017-08-22 00:00:00"],
        ]),
    "order_items.csv": (
        ["order_id", "order_item_id", "product_id", "seller_id", "shipping_limit_date", "price", "freight_value"],
        [
            ["o1", "1", "p1", "s1", "2017-01-12 00:00:00", "100.00", "10.50"],
            ["o1", "2", "p2", "s2", "2017-01-12 00:00:00", "50.25", "5.00"],
            ["o4", "1", "p3", "s1", "2017-02-03 00:00:00", "20.00", "3.10"],
            ["o5", "1", "p1", "s3", "2017-05-06 00:00:00", "30.00", "2.00"],
            ["o7", "1", "p2", "s2", "2017-07-03 00:00:00", "15.50", "4.99"],
            ["o8", "1", "p4", "s1", "2017-08-03 00:00:00", "9.90", "1.00"],
        ]),
    "order_payments.csv": (
        ["order_id", "payment_sequential", "payment_type", "payment_installments", "payment_value"],
        [
            ["o1", "1", "credit_card", "3", "60.00"],
            ["o1", "2", "boleto", "1", "55.75"],
            ["o1", "3", "voucher", "1", "50.00"],
            ["o2", "1", "not_defined", "1", "10.00"],
            ["o4", "1", "credit_card", "2", "20.00"],
            ["o4", "2", "credit_card", "5", "3.10"],
            ["o5", "1", "paypal", "1", "32.00"],
            ["o7", "1", "voucher", "1", "15.00"],
            ["o7", "2", "debit_card", "1", "5.49"],
            ["o8", "1", "boleto", "1", "10.90"],
        ]),
    "order_reviews.csv": (
        ["review_id", "order_id", "review_score", "review_comment_title", "review_comment_message",
         "review_creation_date", "review_answer_timestamp"],
        [
            ["r1", "o1", "5", " Ótimo ", "Muito BOM", "2017-01-16 00:00:00", "2017-01-17 10:00:00"],
            ["r1", "o1", "5", " Ótimo ", "Muito BOM", "2017-01-16 00:00:00", "2017-01-17 10:00:00"],
            ["r2", "o1", "4", "", "", "2017-01-18 00:00:00", "2017-01-18 12:00:00"],
            ["r3", "o4", "3", "ok", "", "2017-02-05 00:00:00", "2017-02-06 09:00:00"],
            ["r3", "o5", "3", "ok", "", "2017-05-08 00:00:00", "2017-05-09 09:00:00"],
            ["r4", "o4", "2", "ruim", "atrasou", "2017-02-05 00:00:00", "2017-02-07 09:00:00"],
        ]),
    "products.csv": (
        ["product_id", "product_category_name", "product_name_lenght", "product_description_lenght",
         "product_photos_qty", "product_weight_g", "product_length_cm", "product_height_cm", "product_width_cm"],
        [
            ["p1", "beleza_saude", "2.5", "3.7", "1", "500", "20", "10", "15"],
            ["p2", "pc_gamer", "40", "300", "2", "1200", "30", "20", "25"],
            ["p3", "", "10", "100", "", "", "", "", ""],
            ["p4", "unknown_cat", "12", "150", "3", "100", "10", "5", "5"],
        ]),
    "sellers.csv": (
        ["seller_id", "seller_zip_code_prefix", "seller_city", "seller_state"],
        [
            ["s1", "01307", "sao paulo", "SP"],
            ["s2", "04004", "são paulo", "SP"],
            ["s3", "99999", "salvador", "BA"],
        ]),
    "geolocation.csv": (
        ["geolocation_zip_code_prefix", "geolocation_lat", "geolocation_lng", "geolocation_city",
         "geolocation_state"],
        [
            ["01307", "-23.5", "-46.6", "são paulo", "SP"],
            ["01307", "-23.7", "-46.8", "sao paulo", "SP"],
            ["04004", "-23.6", "-46.7", "paraiso", "SP"],
            ["12345", "-10.0", "-62.0", "d oeste", "RO"],
            ["22222", "-9.9", "-61.9", "alta floresta do oeste", "RO"],
            ["33333", "-27.8", "-50.3", "lages", "SC"],
            ["44444", "-30.0", "-51.2", "strasse", "RS"],
            ["55555", "-12.7", "-38.3", "abrantes", "BA"],
            ["66666", "-7.1", "-34.9", "santa rita", "PB"],
        ]),
    "category_translation.csv": (
        ["product_category_name", "product_category_name_english"],
        [["beleza_saude", "health_beauty"], ["cama_mesa_banho", "bed_bath_table"]]),
}

HDI_COLS = [f"HDI{p} {y}" for y in (2017, 2010, 2000, 1991) for p in ("", " Education", " Wealth", " Health")]


def _hdi(base: float, off: float = 0.0) -> list[str]:
    out = []
    for k, _y in enumerate((2017, 2010, 2000, 1991)):
        h = round(base - 0.05 * k, 3)
        out += [str(round(h + off, 3)), str(h), str(h), str(h)]
    return out


STATE_STATS = {
    "airports.csv": (["UF", "Passengers rate"], [["SP", "0.4"], ["RJ", "0.2"], ["BA", "0.1"]]),
    "hdi.csv": (["UF"] + HDI_COLS, [["SP"] + _hdi(0.83), ["RJ"] + _hdi(0.79), ["BA"] + _hdi(0.70, off=0.2)]),
    "icu-beds.csv": (["UF", "ICU beds", "Public beds", "Private beds", "Public beds per citizen",
                      "Private beds per citizen"],
                     [["SP", "100", "60", "40", "0.1", "0.1"], ["RJ", "50", "30", "21", "0.1", "0.1"],
                      ["BA", "40", "25", "15", "0.2", "0.1"]]),
    "states.csv": (["UF", "State", "Capital", "Region", "Area", "Population", "Demographic Density",
                    "Cities count", "GDP", "GDP rate", "Poverty", "Latitude", "Longitude"],
                   [[" sp", "São Paulo", "São Paulo", "Southeast", "248219.0", "4591904", "18.5", "645",
                     "2000.0", "0.3", "0.1", "-23.5", "-46.6"],
                    ["RJ", "Rio de Janeiro", "Rio de Janeiro", "Southeast", "43750.0", "1736617", "39.69", "92",
                     "700.0", "0.1", "0.1", "-22.9", "-43.2"],
                    ["BA", "Bahia", "Salvador", "Northeast", "0.0", "1493045", "0.0", "417", "300.0", "0.05",
                     "0.2", "-12.9", "-38.5"]]),
}

SEEDS = {
    "category_map.csv": (["raw_category", "business_area"],
                         [["beleza_saude", "Health & Beauty"], ["pc_gamer", "Electronics"],
                          ["portateis_cozinha_e_preparadores_de_alimentos", "Appliances & Kitchen"]]),
    "municipality_map.csv": (["locality", "municipality"],
                             [["ABRANTES", "CAMACARI"], ["LAGES", "MARANGUAPE"], ["PARAISO", "SAO PAULO"],
                              ["SAO PAULO", "SAO PAULO"]]),
    "typo_cure.csv": (["original_city", "fixed_city"],
                      [["ALTA FLORESTA DO OESTE", "ALTA FLORESTA D OESTE"], ["LAGES SC", "LAGES"],
                       ["D'OESTE", "NEVER"], ["SANTARITA", "SANTA RITA"]]),
    "zip_code_fix.csv": (["zip_code_prefix", "city_associated"], [["01307", "SAO PAULO"], ["04004", "PARAISO"]]),
}


def write_csvs(folder: str, tables: dict) -> str:
    os.makedirs(folder, exist_ok=True)
    for name, (header, rows) in tables.items():
        with open(os.path.join(folder, name), "w", newline="", encoding="utf-8") as f:
            w = csv.writer(f)
            w.writerow(header)
            w.writerows(rows)
    return folder


def write_all(base: str) -> dict[str, str]:
    return {"marketplace": write_csvs(os.path.join(base, "raw_marketplace"), MARKETPLACE),
            "state_stats": write_csvs(os.path.join(base, "raw_state_stats"), STATE_STATS),
            "seeds": write_csvs(os.path.join(base, "seeds"), SEEDS)}
