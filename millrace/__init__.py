"""A PySpark engine that turns saved provider pages and API responses into validated offers."""
