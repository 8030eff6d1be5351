"""recordloom.operators"""
