"""dealscope: CRM sales analytics as Spark DataFrame functions."""
