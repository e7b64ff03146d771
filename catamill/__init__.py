"""catamill: quality, linkage and analytics of crawled catalogs as Spark jobs."""
