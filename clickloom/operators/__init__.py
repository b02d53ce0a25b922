"""DataFrame operators: sessions, filters, statistics, sampling, categories, ad clicks."""
