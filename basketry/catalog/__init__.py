"""The registered queries over the sample tables and the SQL they are checked against."""
