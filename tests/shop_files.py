"""A small shop as delimited files, dirt included."""

from __future__ import annotations

from pathlib import Path

T = "2024-01-01T08:00:00"

CUSTOMERS = """\
customer_id,first_name,last_name,email,date_of_birth,gender,join_date,address_id,created_at,updated_at,,
1,irena,malina,Irena@Mail.pl ,1979-11-02,Kobieta,2022-05-04,1,2022-05-04 07:15:30,2022-05-04 07:15:30,,
2, OLEK,dab ,olek@mail.pl,2090-07-22,M,2022-06-01,2,2022-06-01T12:00:00,2022-06-01T12:00:00,,
3,  ,"Wrona,WRONA@mail.pl,,k,2022-07-01,,2022-07-01T06:00:00,2022-07-01T06:00:00,,
"""
ADDRESSES = f"""\
address_id,country,city,street,postal_code,created_at,updated_at,,
1, Polska,olsztyn ,ul.  Krzywe Kolo 7,10 - 001,{T},{T},,
2,Polska,RADOM,Cicha 5,26-600,{T},{T},,
"""
BRANDS = f"brand_id,name,created_at,updated_at,,\n1, Alfa ,{T},{T},,\n2,Beta,{T},{T},,\n"
CATEGORIES = (
    f"category_id,name,parent_category_id,created_at,updated_at,,\n1,Psy,,{T},{T},,\n"
    f"10,Karma,1,{T},{T},,\n11,Sucha,10,{T},{T},,\n"
)
PRODUCTS = f"""\
product_id,name,description,category_id,brand_id,list_price,created_at,updated_at,,
100, Karma A ,sucha%karma,11,1,10.00,{T},{T},,
101,Karma B,,1,9,-20.50,{T},{T},,
102,Karma C,opis,10,2,,{T},{T},,
"""
PAYMENT_METHODS = (
    f"payment_method_id,payment_method_name,is_active,created_at,updated_at,,\n"
    f"1, Karta ,1,{T},{T},,\n2,Przelew,0,{T},{T},,\n"
)
ORDERS = f"""\
order_id,customer_id,order_date,payment_method_id,session_id,order_status,subtotal_amount,discount_amount,tax_amount,shipping_amount,total_amount,created_at,updated_at,,
500,1,2024-03-05T08:05:00,1,900, new ,-100.00,,5.00,,100.00,{T},{T},,
501,2,2024-03-06T18:45:10,7,,paid,50.00,1.00,,,50.00,{T},{T},,
502,77,2024-04-01T00:00:00,2,902,PAID,10.00,,,,10.00,{T},{T},,
503,1,2024-04-02T00:00:00,2,903,paid,10.00,,,,10.00,{T},{T},,
"""
ORDER_ITEMS = f"""\
order_item_id,order_id,product_id,quantity,unit_price,discount_amount,tax_amount,created_at,updated_at,,
1,500,100,2,10.00,1.00,0.50,{T},{T},,
2,500,101,1,-20.50,,,{T},{T},,
3,501,555,3,5.00,,0.10,{T},{T},,
4,502,102,1,7.00,,,{T},{T},,
5,999,100,1,7.00,,,{T},{T},,
"""
RETURNS = f"""\
return_id,order_item_id,return_date,quantity_returned,refund_amount,reason,created_at,updated_at,,
1,1,2024-03-10T09:30:00,-1,10.00,-,{T},{T},,
2,4,2090-01-01T00:00:00,1,-7.00, ZA duzy,{T},{T},,
3,88,2024-03-11T23:59:59,1,,,{T},{T},,
"""
SESSIONS = """\
website_session_id,created_at,user_id,is_repeat_session,utm_source,utm_campaign,utm_content,device_type,http_referer,,
899,2024-03-01T10:00:00,1,0, Google ,Spring,Banner,Mobile,https://a ,,
900,2024-03-05T08:00:00,1,1,,SUMMER,,,,,
902,2024-04-01T00:00:00,,0,bing,,,desktop,,,
903,2024-04-02T00:00:00,1,1,bing,summer,,desktop,,,
"""
PAGEVIEWS = """\
website_pageview_id,created_at,website_session_id,pageview_url,,
1,2024-03-01T10:00:00.900000,899, /Home,,
2,2024-03-01T10:00:59.100000,899,/cart ,,
3,2024-03-05T08:00:00,900,/home,,
4,2024-03-05T08:01:00,900,/HOME,,
5,2024-04-01T00:00:00,902,/home,,
6,2024-04-01T00:00:00,7777,/cart,,
7,2024-04-02T00:00:00,903,/home,,
"""
FILES = {
    "customers": CUSTOMERS,
    "addresses": ADDRESSES,
    "brands": BRANDS,
    "categories": CATEGORIES,
    "products": PRODUCTS,
    "payment_methods": PAYMENT_METHODS,
    "orders": ORDERS,
    "order_items": ORDER_ITEMS,
    "order_item_returns": RETURNS,
    "website_sessions": SESSIONS,
    "pageviews": PAGEVIEWS,
}


def write_shop(folder: Path, **changed: str) -> str:
    folder.mkdir(parents=True, exist_ok=True)
    for name, text in {**FILES, **changed}.items():
        if text is not None:
            (folder / f"{name}.csv").write_text(text, encoding="utf-8")
    return str(folder)
