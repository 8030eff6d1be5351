"""recordloom.functions"""
