"""Attribution of national-warehouse shipments to their causes, as Spark DataFrame operators."""
