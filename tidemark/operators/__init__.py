"""Relational operators: cleaning, customer aggregates, RFM, profiles, CLV."""
