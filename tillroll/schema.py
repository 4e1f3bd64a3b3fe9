"""Column names and declared schemas of the retail data model."""

from pyspark.sql import types as T

# Column names of the transaction, customer, recommendation
# and comparison tables, kept equal to the names the original jobs read and
# write so that files produced by either side can be exchanged.
INVOICE_NO = "InvoiceNo"
STOCK_CODE = "StockCode"
DESCRIPTION = "Description"
QUANTITY = "Quantity"
INVOICE_DATE = "InvoiceDate"
UNIT_PRICE = "UnitPrice"
CUSTOMER_ID = "CustomerID"
COUNTRY = "Country"
SEGMENT = "segment"
SEGMENT_OLD = "segment_old"
ITEMS = "items"
RECS = "recs"
RECS2 = "recs2"
KEY = "key"
CMP_KEY = "KEY"
CMP_VAL1 = "VAL1"
CMP_VAL2 = "VAL2"
JACCARD_SIM = "jaccard_similarity"
JACCARD_DIS = "jaccard_distance"
SIMILARITY = "similarity"
NO_OF_CUSTOMERS = "noOfCustomers"

PRICE_PER_PURCHASE = "pricePerPurchase"
PRODUCTS_PER_PURCHASE = "productsPerPurchase"
QUANTITY_PER_PURCHASE = "quantityPerPurchase"
PURCHASES_PER_CUSTOMER = "purchasesPerCustomer"
AVG_PRICE_PER_PURCHASE = "avgPricePerPurchasePerCustomer"
AVG_PRODUCTS_PER_PURCHASE = "avgProductsPerPurchasePerCustomer"
AVG_QUANTITY_PER_PURCHASE = "avgQuantityPerPurchasePerCustomer"
SCALED_PREFIX = "scaled_"

# A purchase (basket) is identified by these four columns.
BASKET_KEY = [INVOICE_NO, INVOICE_DATE, CUSTOMER_ID, COUNTRY]

# The four per-customer features, in the order they form the feature vector.
CUSTOMER_FEATURES = [
    PURCHASES_PER_CUSTOMER,
    AVG_PRICE_PER_PURCHASE,
    AVG_PRODUCTS_PER_PURCHASE,
    AVG_QUANTITY_PER_PURCHASE,
]

RAW_COLUMNS = [
    INVOICE_NO, STOCK_CODE, DESCRIPTION, QUANTITY,
    INVOICE_DATE, UNIT_PRICE, CUSTOMER_ID, COUNTRY,
]

# Raw delimited input: every column a string, header row present.
RAW_SCHEMA = T.StructType([T.StructField(c, T.StringType(), True) for c in RAW_COLUMNS])

# Clean transactions.  UnitPrice is a double (the original declared float;
# products of float and int are widened to double anyway).
CLEAN_SCHEMA = T.StructType([
    T.StructField(INVOICE_NO, T.StringType(), True),
    T.StructField(STOCK_CODE, T.StringType(), True),
    T.StructField(DESCRIPTION, T.StringType(), True),
    T.StructField(QUANTITY, T.IntegerType(), True),
    T.StructField(INVOICE_DATE, T.StringType(), True),
    T.StructField(UNIT_PRICE, T.DoubleType(), True),
    T.StructField(CUSTOMER_ID, T.StringType(), True),
    T.StructField(COUNTRY, T.StringType(), True),
])

CUSTOMERS_SCHEMA = T.StructType([
    T.StructField(CUSTOMER_ID, T.StringType(), True),
    T.StructField(SEGMENT, T.StringType(), True),
])
