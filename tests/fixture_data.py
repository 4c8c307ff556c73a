"""The micro fixture: ties, orphans, a zero price, unpadded dates, CRLF line ends."""

import os
import tempfile

PRODUCTS = [
    "Product_ID,Product_Name,Product_Category,Product_Cost,Product_Price",
    "1,Kite,Outdoor,$4.00 ,$10.00 ",
    "2,Yo-Yo,Toys,$1.00 ,$4.00 ",
    "3,Puzzle,Games,$9.00 ,$30.00 ",
    "4,Drum,Toys,$0.00 ,$0.00 ",
]
STORES = [
    "Store_ID,Store_Name,Store_City,Store_Location,Store_Open_Date",
    "1,North 1,North,Downtown,2000-01-01",
    "2,South 1,South,Airport,2005-06-30",
]
SALES = [
    "Sale_ID,Date,Store_ID,Product_ID,Units",
    "1,1/5/2023,1,1,2",
    "2,01/20/2023,1,2,5",
    "3,2/3/2023,2,3,1",
    "4,2/28/2023,1,1,1",
    "5,3/31/2023,2,2,10",
    "6,12/31/2022,1,3,1",
    "7,3/1/2023,9,1,4",
    "8,3/15/2023,2,4,3",
    "9,2/10/2023,2,1,1",
]
INVENTORY = [
    "Store_ID,Product_ID,Stock_On_Hand",
    "1,1,10",
    "1,2,0",
    "2,1,3",
    "2,3,600",
    "2,4,7",
]


def write_fixture(extra_sales=(), extra_products=(), extra_stores=()):
    root = tempfile.mkdtemp(prefix="tillroll-fixture-")
    paths = {}
    for name, lines in (("sales", SALES + list(extra_sales)), ("products", PRODUCTS + list(extra_products)),
                        ("stores", STORES + list(extra_stores)), ("inventory", INVENTORY)):
        path = os.path.join(root, f"{name}.csv")
        with open(path, "w", newline="") as fh:
            fh.write("\r\n".join(lines) + "\r\n")
        paths[name] = path
    return paths
