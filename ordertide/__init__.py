"""Purchase-order tracking on Spark: status ladder and stage timeline."""
