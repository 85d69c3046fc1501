"""specloom: product-catalogue analytics as Spark DataFrame operators."""
