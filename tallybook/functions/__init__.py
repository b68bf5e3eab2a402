"""Column functions. All of them are compositions of Spark built-ins and stay in codegen."""
