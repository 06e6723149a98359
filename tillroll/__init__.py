"""tillroll: receipt mails to classified transactions, as Spark DataFrame operators."""
