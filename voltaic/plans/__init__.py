"""Silver and gold steps composed from the operators, and the reports."""
