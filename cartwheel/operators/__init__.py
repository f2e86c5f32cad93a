"""DataFrame -> DataFrame operators: sales analytics, reports, generators, weighted sampling."""
