-- Customers and balance per market segment (extract for distribution).
SELECT c_mktsegment,
       count(*) AS customers,
       round(sum(c_acctbal), 2) AS balance
FROM IDENTIFIER(:source_table)
GROUP BY c_mktsegment
