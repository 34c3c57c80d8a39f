"""pricelake: a Spark-native retail price analytics engine.

Two store feeds (retailer A = store 1000, retailer B = store 1001) are
normalised, kept as SCD2 history, reduced to brand/category dimensions,
given canonical product ids (B is fuzzy-matched onto A inside
brand x category blocks), bridged per store SKU, turned into a price
observation fact and read by gold comparison/trend/promo/basket queries.

Every operator is a ``DataFrame -> DataFrame`` function; nothing runs on
the driver beyond plan construction.
"""

STORE_A = 1000
STORE_B = 1001
