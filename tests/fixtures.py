"""Small hand-made raw files (FIXTURES.md §1), written as text into a folder."""

from __future__ import annotations

import os

F1 = """order_id,order_date,customer_id,product_id,asin,quantity,total_price,category,seller_id
1,2024-01-01,c1,p1,A1,2,10.50,toys,s1
2,2024-01-01,c2,p2,A2,1,5.25,books,s2
3,2024-01-02,c1,p1,A1,3,15.75,toys,s1
"""

F2 = """order_id,customer_id,order_datetime,sale_amount,units,sku,department,merchant
4,c3,2024-01-03 10:00:00,7.00,1,p3,garden,s3
5,c1,2024-01-03 11:30:00,3.00,2,p1,toys,s1
"""

F3 = """order_id,customer_id,date,unit_price,qty,product_title,category_name,seller
6,c2,2024-01-04,2.50,4,Widget,tools,s2
"""

F4 = """order_id,customer_id
7,c4
8,c5
"""

# F1 columns reordered plus a region column: same folder as F1
F5 = """total_price,quantity,region,seller_id,category,asin,product_id,customer_id,order_date,order_id
9.99,1,EU,s4,books,A9,p9,c6,2024-01-05,9
"""

F6 = """ Order_ID ,Order_Date, Total_Price ,QUANTITY,Category,Seller_ID
10,2024-01-06,12.00,3,toys,s1
"""

F7 = """order_id,order_date,customer_id,product_id,quantity,total_price,category,seller_id
00012,2024-01-07,c7,p7,12.5,oops,toys,s5
00013,31/12/2024,c7,p7,2,$5,toys,s5
00014,2024-01-08,c8,p8,,"1,234.50",toys,s5
00015,,c8,p8,1,,toys,
"""

F10 = """order_id,order_date,price,total_price,product,product_title,quantity
11,2024-01-09,1.00,9.00,prodA,Title A,1
"""


def write(folder: str, name: str, text: str) -> str:
    os.makedirs(folder, exist_ok=True)
    path = os.path.join(folder, name)
    with open(path, "w") as fh:
        fh.write(text)
    return path


def sales_frame(spark, rows, schema="order_id string, customer_id string, sale_date date, total_price double, quantity long, product_id_canon string, category_canon string, seller_canon string"):
    return spark.createDataFrame(rows, schema)
