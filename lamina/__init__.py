"""A layered analytics engine on Spark: landing, bronze, silver, gold, publishing."""
